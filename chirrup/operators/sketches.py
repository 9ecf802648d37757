"""Mergeable sketches of distinct counts and quantiles.

A sketch is a binary value of bounded size, so partial results of a day or a partition can be
stored and merged without reading the rows again. Distinct counts are HyperLogLog sketches with
2^lg_k registers (relative standard error about 0.83 / 2^(lg_k / 2)); quantiles are KLL sketches,
whose error is in rank and shrinks with k (about 0.7 percent of all rows at k = 400).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chirrup.functions import cleaning as C

LG_K, K = 12, 400


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """One sketch per column and group; null values are not counted."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, from finer ones."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def distinct_estimates(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, estimate)."""
    estimates = sketches.select(*by, *[F.hll_sketch_estimate(c).alias(c) for c in columns])
    return estimates.unpivot(list(by), list(columns), "column_name", "estimate")


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One sketch per numeric column and group; null values are left out."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])


def merged_quantiles(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in columns])


def quantile(sketch: str | Column, p: float) -> Column:
    """The value at rank share `p`; null for a sketch without values."""
    column = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_double(column) > 0, F.kll_sketch_get_quantile_double(column, F.lit(p)))


def rank_error(df: DataFrame, column: str, value: Column, p: float) -> Column:
    """How far `value` is from rank share `p`, as an aggregate over the rows themselves."""
    n = F.nullif(F.count(column), F.lit(0))
    low, high = F.count_if(F.col(column) < value) / n, F.count_if(F.col(column) <= value) / n
    return F.greatest(low - p, F.lit(p) - high, F.lit(0.0))


def follower_deciles_sketched(users: DataFrame, posts: DataFrame, low: float = 0.1, high: float = 0.9, k: int = K) -> DataFrame:
    """Mean engagement of posts beyond the low and high follower cuts, with cuts from one sketch.

    Nothing is ranked or sorted: one pass sketches the followers of each post's
    author, a second takes the means. Posts without a known author or follower
    count are left out.
    """
    engagement = C.engagement_known("likes", "shares", "comments").cast("double")
    known = users.select("user_id", F.col("follower_count").alias("v")).where(F.col("v").isNotNull())
    rows = posts.select("user_id", engagement.alias("engagement")).join(known, "user_id")
    cuts = rows.agg(F.kll_sketch_agg_double(F.col("v").cast("double"), F.lit(k)).alias("s")).select(F.struct(quantile("s", low).alias("low"), quantile("s", high).alias("high"))).scalar()

    def mean(side: Column) -> Column:
        return F.avg(F.when(side, F.col("engagement")))

    return rows.agg(F.first(cuts["high"]).alias("top_cut"), F.first(cuts["low"]).alias("bottom_cut"),
                    mean(F.col("v") >= cuts["high"]).alias("top_mean"), mean(F.col("v") <= cuts["low"]).alias("bottom_mean"))
