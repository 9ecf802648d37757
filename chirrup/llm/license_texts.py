"""Known license wordings (fixed values): public license texts and the usual one-line notices."""

from pathlib import Path

MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

BSD_3 = BSD_2.replace("\n\nTHIS SOFTWARE", """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE""")

# Full texts as files of the package; read on the driver when the list is built.
FILES = (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"))
FULL = tuple((name, (Path(__file__).parent / "license_files" / f"{file}.txt").read_text(encoding="utf-8")) for name, file in FILES)

# How a notice names each license; every license has the same notices.
NAMES = (
    ("MIT", "the MIT License"), ("ISC", "the ISC License"), ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("Zlib", "the zlib License"), ("Apache-2.0", "the Apache License, Version 2.0"), ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("GPL-2.0", "the GNU General Public License, version 2"), ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"), ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC0-1.0", "CC0 1.0"),
)
NOTICES = tuple((name, f"{start} under {called}.") for name, called in NAMES for start in ("Licensed", "Released", "This work is licensed"))

KNOWN = (
    ("MIT", MIT_GRANT),
    ("MIT", "MIT License\n" + MIT_GRANT),
    ("MIT", "The MIT License\n" + MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n" + MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("ISC", ISC_GRANT),
    ("ISC", "ISC License\n" + ISC_GRANT),
    ("ISC", "Released under the ISC License."),
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("Zlib", ZLIB),
    ("Zlib", "zlib License\n" + ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
)
KNOWN = tuple(dict.fromkeys(KNOWN + NOTICES + FULL))
