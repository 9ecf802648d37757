"""Fill-in-the-middle by in-place block rotation.

A text is cut twice between its units (runs of ASCII letters, or one other code point). The
sentinels go into a bytearray of the text in reading order, and the block that has to come first
is exchanged with its neighbour by three reversals. The inverse finds the sentinels, rotates back
and takes them out, so the text comes back byte for byte.

Defined results: a null text counts as empty; empty texts, texts that hold a sentinel and a
share of all texts stay plain, with null prefix and middle. A null key is hashed like an empty
one. Each row stands alone, so repeated rows get equal results. Both functions are column
expressions, so other columns of any name stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from chirrup.llm.common import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_WIDE = len(PREFIX)
_BLOCK = 1 << 20  # bytes scanned at once

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point

_RESULT = pa.struct([
    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


@dataclass(frozen=True)
class MiddleParams:
    """`seed` starts the hashed key; percentages of texts left plain and, of the others, with the suffix first."""

    seed: str = "1"
    plain_from: int = 90
    suffix_first_below: int = 20


def fill_in_middle(text: Column, key: Column, params: MiddleParams = MiddleParams()) -> Column:
    """struct(n units, form, prefix_chars, middle_chars, output) of a text, drawn by its key."""

    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        done = []
        for part in _parts(texts, keys):
            rows = [_transformed(t.as_buffer() if t.is_valid else b"", k.as_py(), params) for t, k in zip(*part)]
            columns = [pa.array([r[f.name] for r in rows], pa.binary() if f.name == "output" else f.type).cast(f.type) for f in _RESULT]
            done.append(pa.StructArray.from_arrays(columns, fields=list(_RESULT)))
        return pa.concat_arrays(done) if done else pa.array([], _RESULT)

    return F.arrow_udf(run, "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>")(
        text, F.coalesce(key.cast("string"), F.lit("")))


def restore(output: Column, form: Column) -> Column:
    """The text an output was made from, by its form alone; null if either is null."""

    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        done = []
        for part in _parts(outputs, forms):
            back = [restored(o.as_buffer(), f.as_py()) if o.is_valid and f.is_valid else None for o, f in zip(*part)]
            done.append(pa.array(back, pa.binary()).cast(pa.string()))
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return F.arrow_udf(run, "string")(output, form)


def _parts(texts: pa.Array, other: pa.Array) -> Iterator[list[pa.Array]]:
    """Both columns in row runs of bounded text bytes, so that only one run is held as Python objects."""
    for batch in slices(pa.RecordBatch.from_arrays([texts, other], ["text", "other"]), "text"):
        yield batch.columns


def _unit_starts(data: np.ndarray, at: int) -> np.ndarray:
    """Whether a unit starts at each byte of one block."""
    block = data[at : at + _BLOCK]
    letter = _LETTER[block]
    before = np.concatenate(([bool(at) and _LETTER[data[at - 1]]], letter[:-1]))
    return _LEAD[block] & ~(letter & before)


def _cuts(data: np.ndarray, counts: np.ndarray, units: list[int]) -> list[int]:
    """Byte offsets after so many units, given the units that start in each block."""
    upto = np.cumsum(counts)
    out = []
    for c in units:
        k = int(np.searchsorted(upto, c, side="right"))
        if k == len(upto):
            out.append(len(data))
        else:
            here = np.flatnonzero(_unit_starts(data, k * _BLOCK))
            out.append(k * _BLOCK + int(here[c - upto[k] + counts[k]]))
    return out


def _chars(data: np.ndarray) -> int:
    return sum(int(_LEAD[data[i : i + _BLOCK]].sum()) for i in range(0, len(data), _BLOCK))


def _reverse(view: np.ndarray) -> None:
    half = len(view) // 2
    kept = view[:half].copy()
    view[:half] = view[len(view) - half :][::-1]
    view[len(view) - half :] = kept[::-1]


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, middle) and [middle, end) in place by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    _reverse(view[start:middle])
    _reverse(view[middle:end])
    _reverse(view[start:end])


def _transformed(raw, key: str, params: MiddleParams) -> dict:
    data = np.frombuffer(raw, np.uint8)
    counts = np.array([_unit_starts(data, i).sum() for i in range(0, len(data), _BLOCK)], np.int64)
    n = int(counts.sum())
    digest = hashlib.sha256(f"{params.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    buffer = bytearray(raw)
    if not n or h3 % 100 >= params.plain_from or any(s in buffer for s in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": bytes(buffer)}
    low, high = _cuts(data, counts, sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix_chars, middle_chars = _chars(data[:low]), _chars(data[low:high])
    # <P>prefix<M>middle<S>suffix, then the suffix moves before the middle or to the front
    buffer[high:high] = SUFFIX
    buffer[low:low] = MIDDLE
    buffer[0:0] = PREFIX
    suffix_at = high + 2 * _WIDE
    first = h4 % 100 < params.suffix_first_below
    rotate(buffer, 0 if first else low + _WIDE, suffix_at, len(buffer))
    return {"n": n, "form": "spm" if first else "psm", "prefix_chars": prefix_chars, "middle_chars": middle_chars, "output": bytes(buffer)}


def restored(output, form: str) -> bytes:
    """The original bytes: the rotation is inverted, then the sentinels are cut out from the back."""
    buffer = bytearray(output)
    if form == "plain":
        return bytes(buffer)
    if form == "psm":
        start, turn = buffer.find(SUFFIX), buffer.find(MIDDLE)
    elif form == "spm":
        start, turn = buffer.find(SUFFIX), buffer.find(PREFIX)
    else:
        raise ValueError(f"unknown form {form!r}")
    if not 0 <= start < turn:
        raise ValueError(f"no {form} output: sentinels are missing or out of order")
    rotate(buffer, start, turn, len(buffer))
    suffix_at = len(buffer) - (turn - start)
    middle_at = buffer.find(MIDDLE)
    for at in (suffix_at, middle_at, 0):
        del buffer[at : at + _WIDE]
    return bytes(buffer)
