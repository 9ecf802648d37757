"""Column and text profiles: one pass per table wherever possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chirrup.functions import cleaning as C, text as X


def missing_profile(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Placeholder or null count and rate per column, in one scan."""
    wide = raw.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(C.is_missing(c)).alias(c) for c in columns]
    )
    long = wide.unpivot(["_rows"], list(columns), "column_name", "n_missing")
    rate = 100.0 * F.col("n_missing") / F.col("_rows")
    return long.select("column_name", "n_missing", F.round(rate, 1).alias("pct_missing"))


def numeric_profile(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unreadable and negative counts, minimum and maximum, in one scan."""
    parts = []
    for c in columns:
        v = C.strip(c).try_cast("bigint")
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(v.isNull()).alias("non_numeric"),
                F.count_if(v < 0).alias("negative"),
                F.min(v).alias("min_value"),
                F.max(v).alias("max_value"),
            )
        )
    return raw.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def date_profile(raw: DataFrame, column: str) -> DataFrame:
    d = C.strip(column).try_cast("date")
    return raw.agg(
        F.count_if(d.isNull()).alias("unparsable"), F.min(d).alias("min_date"), F.max(d).alias("max_date")
    )


def sign_profile(raw: DataFrame, column: str = "likes") -> DataFrame:
    """Distribution of non-negative values beside that of flipped ones."""
    v = C.to_long_or_null(column)
    sided = raw.select(F.when(v < 0, "negative").otherwise("positive").alias("side"), F.abs(v).alias("v"))
    return (
        sided.filter(F.col("v").isNotNull())
        .groupBy("side")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min_value"),
            F.max("v").alias("max_value"),
        )
    )


def timestamp_formats(raw: DataFrame, column: str = "timestamp") -> DataFrame:
    return raw.groupBy(C.timestamp_format(column).alias("format")).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct present values per column.

    Values are unpivoted and grouped, so each distinct value is one row of a
    shuffled table and never part of a set held by one task.
    """
    values = raw.select(*[C.normalize_missing(c).alias(c) for c in columns])
    long = values.unpivot([], list(columns), "column_name", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.lit(1).alias("one")).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_distinct")
    )


def value_list(raw: DataFrame, column: str) -> DataFrame:
    """Distinct present values of one column, as sorted rows."""
    return (
        raw.select(C.normalize_missing(column).alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("value")
    )


def duplicate_profile(raw: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """Per named key: rows beyond the first, rows in repeated groups, groups."""
    out = None
    for name, cols in keys.items():
        n = F.col("n")
        one = (
            raw.groupBy(*C.digest_key(raw, cols))
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_rows"),
                F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("rows_in_groups"),
                F.count_if(n > 1).alias("groups"),
            )
            .select(F.lit(name).alias("key_name"), "extra_rows", "rows_in_groups", "groups")
        )
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------- texts
def length_stats(df: DataFrame, text: str, groups: Sequence[str] = ()) -> DataFrame:
    """Min, max, mean, median, std of character and word counts per group.

    The exact median keeps a count per distinct length, which is bounded by the
    longest text and not by the number of texts.
    """
    sized = df.select(*groups, F.length(text).cast("bigint").alias("chars"), X.word_count(text).alias("words"))
    stats = []
    for c in ("chars", "words"):
        stats += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.round(F.avg(c), 2).alias(f"{c}_mean"),
            F.median(c).alias(f"{c}_median"),
            F.round(F.stddev_samp(c), 2).alias(f"{c}_std"),
        ]
    return sized.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *stats)


QUALITY_PATTERNS: dict[str, str] = {
    # fixed values: the audited text issues
    "unicode_escape": X.ESCAPE,
    "html_entity": X.ENTITY,
    "at_user": r"(?iU)@user\b",
    "at_other": r"(?U)@(?!user\b)[A-Za-z0-9_]+",
    "url": f"(?U){X.URL}",
    "hashtag": X.HASHTAG,
}


def text_quality(df: DataFrame, text: str) -> DataFrame:
    """Rows and share of rows showing each issue, all patterns in one scan."""
    names = list(QUALITY_PATTERNS)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(text).rlike(QUALITY_PATTERNS[n])).alias(n) for n in names],
    )
    long = wide.unpivot(["_rows"], names, "issue", "n_rows")
    return long.select("issue", "n_rows", F.round(100.0 * F.col("n_rows") / F.col("_rows"), 1).alias("pct"))


def changed_by_cleaning(df: DataFrame, raw: str, cleaned: str) -> DataFrame:
    changed = ~F.col(raw).eqNullSafe(F.col(cleaned))
    return df.agg(F.count_if(changed).alias("changed"), F.count_if(~changed).alias("unchanged"))


def first_examples(df: DataFrame, condition: Column, key: str, columns: Sequence[str], n: int = 3) -> DataFrame:
    """The first rows by key that show a condition."""
    return df.filter(condition).orderBy(key).limit(n).select(key, *columns)


def label_consistency(df: DataFrame, text: str, labels: Sequence[str]) -> DataFrame:
    """Groups of equal texts, and how many carry more than one label.

    Minimum and maximum differ exactly when there are two or more labels, and
    unlike a distinct count they combine map-side in constant space.
    """
    groups = df.groupBy(*C.digest_key(df, [text])).agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.min(c) != F.max(c)).alias(f"mixed_{c}") for c in labels],
    )
    return groups.filter(F.col("n") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"),
        *[F.count_if(F.col(f"mixed_{c}")).alias(f"mixed_{c}") for c in labels],
    )


def feature_rates(df: DataFrame, text: str, label: str) -> DataFrame:
    """Share of texts with mentions and hashtags per class, and mean counts."""
    mentions = F.regexp_count(text, F.lit("@user"))
    tags = X.pattern_count(text, X.HASHTAG)
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(100.0 * F.avg(F.col(text).contains("@user").cast("int")), 1).alias("pct_has_mention"),
        F.round(F.avg(mentions), 2).alias("mean_mentions"),
        F.round(100.0 * F.avg((tags > 0).cast("int")), 1).alias("pct_has_hashtag"),
        F.round(F.avg(tags), 2).alias("mean_hashtags"),
    )
