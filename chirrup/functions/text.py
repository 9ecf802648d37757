"""Text functions as Column expressions.

Word characters are spelled out as `[\\p{L}\\p{N}_]` (letters, numbers,
underscore in any script), because Java's bare `\\w` and `\\b` are ASCII only.
Full HTML entity decoding is the one step without a built-in; it runs as an
Arrow UDF that only receives the texts holding an ampersand.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

from chirrup import params as P
from chirrup.functions.cleaning import col_of, strip

WORD = r"[\p{L}\p{N}_]"
NOT_IN_WORD = rf"(?<!{WORD})"
NOT_BEFORE_WORD = rf"(?!{WORD})"

# --- fixed values: the cleaning patterns
MENTION = "@[A-Za-z0-9_]+"
URL = r"https?://\S+|www\.\S+"
ESCAPE = r"\\u[0-9A-Fa-f]{4}"
ENTITY = "(?i)&(?:amp|quot|#39|lt|gt);"
HASHTAG = "#[A-Za-z0-9_]+"

_HIGH = r"\\u[dD][89abAB][0-9A-Fa-f]{2}"
_LOW = r"\\u[dD][c-fC-F][0-9A-Fa-f]{2}"
_PLAIN = r"\\u(?![dD][89a-fA-F])[0-9A-Fa-f]{4}"
_DECODABLE = rf"(?:{_HIGH}{_LOW}|{_PLAIN})+"
_LONE = r"\\u[dD][89a-fA-F][0-9A-Fa-f]{2}"


# ---------------------------------------------------------------- cleaning
def decode_escapes(c: str | Column) -> Column:
    r"""Turn literal `\uXXXX` sequences into characters, pairs joined.

    Texts without a backslash skip the work. The text is cut into runs, runs of
    escapes are decoded as UTF-16, everything else is kept; half of a pair
    standing alone becomes the replacement character.
    """
    c = col_of(c)
    runs = F.regexp_extract_all(c, F.lit(rf"{_DECODABLE}|{_LONE}|[^\\]+|\\"), F.lit(0))
    decoded = F.transform(
        runs,
        lambda r: F.when(
            r.rlike(f"^{_DECODABLE}$"),
            F.decode(F.unhex(F.regexp_replace(r, r"\\u", "")), "UTF-16BE"),
        )
        .when(r.rlike(f"^{_LONE}$"), F.lit("�"))
        .otherwise(r),
    )
    return F.when(c.contains("\\u"), F.array_join(decoded, "")).otherwise(c)


def unescape_html(c: str | Column, passes: int = 3) -> Column:
    """Decode HTML entities, repeated for doubly encoded text.

    The function is self-contained, so executors need no copy of this package.
    """

    def unescape(texts: pd.Series) -> pd.Series:
        import html

        def decode(text):
            for _ in range(passes if text is not None else 0):
                once = html.unescape(text)
                if once == text:
                    break
                text = once
            return text

        return texts.map(decode)

    c = col_of(c)
    decoded = F.pandas_udf(unescape, "string")(F.when(c.contains("&"), c))
    return F.coalesce(decoded, c)


def mask_mentions(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), MENTION, "@user")


def mask_urls(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), f"(?U){URL}", "<url>")


def collapse_blanks(c: str | Column) -> Column:
    """Runs of blanks and tabs to one blank; line breaks stay; ends stripped."""
    return strip(F.regexp_replace(col_of(c), r"[ \t]+", " "))


def clean_text(c: str | Column) -> Column:
    """Escapes, entities, mentions, links, blanks, in this order."""
    decoded = unescape_html(decode_escapes(c))
    return collapse_blanks(mask_urls(mask_mentions(decoded)))


def restore_text(c: str | Column) -> Column:
    """Decode entities once and strip; empty text becomes null."""
    return F.nullif(strip(unescape_html(c, passes=1)), F.lit(""))


def clean_for_topics(c: str | Column) -> Column:
    """Drop placeholders, links, mentions, hash signs, numbers, tiny words."""
    noise = rf"(?iU)<url>|<amp>|&amp;|{URL}|{NOT_IN_WORD}#(?=\S)|@{WORD}+"
    t = F.regexp_replace(col_of(c), noise, " ")
    t = F.regexp_replace(t, rf"{NOT_IN_WORD}\p{{Nd}}+{NOT_BEFORE_WORD}", " ")
    t = F.regexp_replace(t, rf"{NOT_IN_WORD}{WORD}{{1,2}}{NOT_BEFORE_WORD}", " ")
    return strip(F.regexp_replace(t, r"(?U)\s+", " "))


# ---------------------------------------------------------------- counting
def words(c: str | Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(col_of(c), r"(?U)\s+"), lambda w: w != "")


def word_count(c: str | Column) -> Column:
    return F.size(words(c)).cast("bigint")


def pattern_count(c: str | Column, pattern: str) -> Column:
    return F.regexp_count(col_of(c), F.lit(pattern)).cast("bigint")


def hashtags(c: str | Column) -> Column:
    return F.regexp_extract_all(col_of(c), F.lit(rf"#({WORD}+)"), F.lit(1))


def _whole_words(options: Iterable[str]) -> str:
    return rf"{NOT_IN_WORD}(?:{'|'.join(options)}){NOT_BEFORE_WORD}"


def has_negation(c: str | Column) -> Column:
    return col_of(c).rlike("(?iu)" + _whole_words(P.NEGATION_WORDS))


def has_sarcasm(c: str | Column) -> Column:
    marks = "|".join(P.SARCASM_MARKS)
    return col_of(c).rlike(f"(?iu){_whole_words(P.SARCASM_WORDS)}|{marks}")


def has_any_phrase(c: str | Column, phrases: Iterable[str]) -> Column:
    return reduce(or_, [col_of(c).contains(p) for p in phrases])


def english_stop_words() -> tuple[str, ...]:
    """The English stop words that Spark ships (needs a running session)."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def mentions_product(c: str | Column) -> Column:
    return col_of(c).rlike("(?iU)" + _whole_words(P.PRODUCT_KEYWORDS))


def entity_pattern(name: str) -> str:
    words_ = name.replace(" ", r"\s*")
    return P.ENTITY_EXCEPTIONS.get(name, rf"(?i)\b{words_}\b")


def entities(c: str | Column, names: Iterable[str] = P.ENTITY_NAMES) -> Column:
    """Names of the dictionary found in the text, each once."""
    c = col_of(c)
    found = [F.when(c.rlike("(?U)" + entity_pattern(n)), F.lit(n)) for n in names]
    return F.array_compact(F.array(*found))


# --------------------------------------------------------------- tokenising
def word_tokens(c: str | Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(col_of(c)), F.lit(rf"{WORD}{{2,}}"), F.lit(0))


def social_tokens(c: str | Column) -> Column:
    """Lower-cased ASCII tokens that may hold `'`, `#`, `_` and `-`.

    A token starts with a letter or hash sign at a word boundary, has two or
    more characters and ends at a word boundary.
    """
    boundary_end = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
    start = rf"(?:(?<!{WORD})[A-Za-z]|(?<={WORD})#)"
    pattern = rf"{start}[A-Za-z0-9'#_-]+{boundary_end}"
    return F.regexp_extract_all(F.lower(col_of(c)), F.lit(pattern), F.lit(0))


def topic_tokens(c: str | Column) -> Column:
    """Lower-cased ASCII tokens of three or more characters, no boundaries."""
    return F.regexp_extract_all(F.lower(col_of(c)), F.lit("[a-z][a-z0-9']{2,}"), F.lit(0))


def without_stop_words(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Remove stop words, repeats of other tokens stay."""
    stops = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(*stops))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of `low` to `high` neighbouring tokens, joined by a blank.

    `tokens` should be a plain column: the lambdas below read it by position,
    and an expression in its place would be evaluated once per element.
    """

    def runs_of(n: int) -> Column:
        if n == 1:
            return tokens
        spots = F.sequence(F.lit(0), F.greatest(F.size(tokens) - F.lit(n), F.lit(0)))
        runs = F.transform(spots, lambda i: F.concat_ws(" ", *[F.get(tokens, i + F.lit(k)) for k in range(n)]))
        return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.concat(*[runs_of(n) for n in range(low, high + 1)])


def char_ngrams(c: str | Column, low: int, high: int) -> Column:
    """Character n-grams (n >= 3) inside words padded with one blank each side.

    A look-ahead group matches at every position without consuming text, so
    each position yields the one gram of n characters that starts there and
    holds blanks at its ends only. A padded word shorter than the smallest n is
    taken whole, once. Positions inside a surrogate pair are skipped.
    """
    if low < 3:
        raise ValueError("character n-grams start at n = 3")
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(col_of(c)), r"(?U)\s+", " ")), F.lit(" "))

    def grams(n: int) -> Column:
        shapes = [rf"\S{{{n}}}", rf" \S{{{n - 1}}}", rf"\S{{{n - 1}}} ", rf" \S{{{n - 2}}} "]
        if n == low > 3:
            shapes.append(rf" \S{{1,{n - 3}}} ")
        pattern = rf"(?U)(?![\x{{DC00}}-\x{{DFFF}}])(?=({'|'.join(shapes)}))"
        return F.regexp_extract_all(line, F.lit(pattern), F.lit(1))

    return F.concat(*[grams(n) for n in range(low, high + 1)])
