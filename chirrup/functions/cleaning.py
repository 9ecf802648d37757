"""Scalar cleaning: placeholders, numbers, timestamps, engagement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F

from chirrup.params import FALLBACK_SENTIMENT, NULL_LITERALS

UNIX_PATTERN = "^[0-9]{10}$"
ISO_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"
DMY_PATTERN = "^([0-9]{2})-([0-9]{2})-([0-9]{4})$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def is_missing(c: str | Column) -> Column:
    """True for null and for every placeholder spelling; never null."""
    v = strip(c)
    return col_of(c).isNull() | F.upper(v).isin(*NULL_LITERALS)


def normalize_missing(c: str | Column) -> Column:
    v = strip(c)
    return F.when(~F.upper(v).isin(*NULL_LITERALS), v)


def to_long_or_null(c: str | Column) -> Column:
    """Lenient number: placeholders and garbage become null (never NaN).

    `12.0` and `1e3` are read as well; a fraction is rounded half to even, since counts are whole.
    """
    v = normalize_missing(c)
    number = v.try_cast("double")
    return F.coalesce(v.try_cast("bigint"), F.when(~F.isnan(number), F.bround(number).try_cast("bigint")))


def to_long_strict(c: str | Column) -> Column:
    """Strict number: ANSI cast, a bad value fails the job."""
    return strip(c).cast("bigint")


def timestamp_format(c: str | Column) -> Column:
    v = strip(c)
    return (
        F.when(v.rlike(UNIX_PATTERN), "unix_epoch")
        .when(v.rlike(ISO_PATTERN), "iso_8601")
        .when(v.rlike(DMY_PATTERN), "dd_mm_yyyy")
        .otherwise("unknown")
    )


def parse_timestamp(c: str | Column) -> Column:
    """One zone-free timestamp from the three raw formats, else null.

    Epoch seconds are added to an NTZ origin, so the result does not depend on
    the session time zone. A day that does not exist gives null.
    """
    v = strip(c)
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    epoch = origin + F.make_dt_interval(secs=v.try_cast("decimal(18,6)"))
    day_first = F.regexp_replace(v, DMY_PATTERN, "$3-$2-$1")
    return (
        F.when(v.rlike(UNIX_PATTERN), epoch)
        .when(v.rlike(ISO_PATTERN), v.try_cast("timestamp_ntz"))
        .when(v.rlike(DMY_PATTERN), day_first.try_cast("timestamp_ntz"))
    )


def parse_instant(c: str | Column) -> Column:
    """ISO-8601 text with any offset to an instant, bad text to null."""
    return col_of(c).try_cast("timestamp")


def is_future_dated(created: Column, collected: Column) -> Column:
    """Source time after collection time; unknown times are not flagged."""
    return F.coalesce(created > collected, F.lit(False))


def label_or_fallback(c: str | Column, fallback: str = FALLBACK_SENTIMENT) -> Column:
    return F.coalesce(F.nullif(col_of(c), F.lit("")), F.lit(fallback))


def engagement_total(likes: str = "likes", shares: str = "shares", comments: str = "comments") -> Column:
    """Missing likes count as zero; shares and comments are always present."""
    return F.coalesce(F.col(likes), F.lit(0)) + F.col(shares) + F.col(comments)


def digest_key(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Grouping keys in place of `cols`: the text columns as one 256-bit digest, so no text is shuffled."""
    kinds = dict(df.dtypes)
    texts = [c for c in cols if kinds[c] == "string"]
    packed = F.to_json(F.struct(*[F.col(c) for c in texts]), {"ignoreNullFields": "false"})
    digest = [F.unhex(F.sha2(packed, 256)).alias("_digest")] if texts else []
    return [F.col(c).alias(f"_key_{c}") for c in cols if kinds[c] != "string"] + digest


def engagement_known(*parts: str) -> Column:
    """Sum of the parts that are present, null only when all are missing."""
    cols = [F.col(p) for p in parts]
    total = reduce(add, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def engagement_counters(*parts: str) -> Column:
    """Text counters: empty is zero, one unreadable counter zeroes the row."""
    filled = [F.coalesce(F.nullif(F.col(p), F.lit("")), F.lit("0")) for p in parts]
    numbers = [f.try_cast("bigint") for f in filled]
    readable = reduce(and_, [n.isNotNull() for n in numbers])
    return F.when(readable, reduce(add, numbers)).otherwise(F.lit(0))
