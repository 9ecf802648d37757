"""Ranking, seeded order and exact quantiles without a single big task."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F


def small_side(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Broadcast hint only after the row count was checked.

    Meant for narrow tables that are already written (`cut_lineage`) or cheap
    to count. Larger tables get no hint: the join then shuffles, and AQE splits
    skewed keys.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
    name: str = "rank", ties: bool = False,
) -> DataFrame:
    """First `n` rows of each group; with `ties`, rank ties at `n` are kept.

    The filter on the rank becomes a group limit below the shuffle, so a group
    holding most rows reaches its task already cut by every map task.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    rank = (F.rank() if ties else F.row_number()).over(w)
    return df.withColumn(name, rank).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint"))


def seeded_key(key: Column, seed: int = 42) -> Column:
    """Reproducible shuffle order: the digest of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly `n` rows (or all, if fewer), the same ones on every run."""
    return df.orderBy(seeded_key(F.col(key), seed), key).limit(n)


def seeded_sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    order = [seeded_key(F.col(key), seed), F.col(key)]
    return top_per_group(df, [group], order, n, name="position")


def positions_in_strata(df: DataFrame, stratum: str, order_key: str, tie: str) -> DataFrame:
    """1-based `position` by a hex digest and `stratum_size`, per stratum.

    A stratum may hold most of the data, so it is never sorted as a whole. Its
    digests are uniform: their first three digits cut it into 4,096 slices that
    are ranked on their own, and slice totals give each slice its offset.
    """
    sliced = df.withColumn("slice", F.substring(order_key, 1, 3))
    sizes = sliced.groupBy(stratum, "slice").agg(F.count(F.lit(1)).alias("slice_size"))
    before = Window.partitionBy(stratum).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        stratum,
        "slice",
        F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("offset"),
        F.sum("slice_size").over(Window.partitionBy(stratum)).alias("stratum_size"),
    )
    inside = Window.partitionBy(stratum, "slice").orderBy(order_key, tie)
    ranked = sliced.withColumn("in_slice", F.row_number().over(inside))
    return (
        ranked.join(offsets, [stratum, "slice"])
        .withColumn("position", F.col("in_slice") + F.col("offset"))
        .drop("slice", "in_slice", "offset")
    )


_SKETCH_ACCURACY = 10_000
_SMALL = 100_000


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], n: int) -> dict[int, float]:
    """Exact values at 0-based ranks among the `n` non-null values.

    A mergeable sketch brackets each rank, counting below, on and between the
    bracket ends tells where the rank falls, and only the open interval in
    between (under a thousandth of the rows per round) is looked at again. Only
    intervals of at most 100,000 rows are sorted in one task; the driver sees
    counts and bracket ends.
    """
    v = F.col(column)
    values = df.select(column).filter(v.isNotNull())
    found: dict[int, float] = {}
    for rank in sorted(set(ranks)):
        part, local, size = values, rank, n
        while rank not in found:
            if size <= _SMALL:
                ordered = F.sort_array(F.collect_list(column))
                found[rank] = part.agg(F.element_at(ordered, local + 1)).head()[0]
                break
            p = local / (size - 1)
            step = 2.0 / _SKETCH_ACCURACY
            ends = [max(p - step, 0.0), min(p + step, 1.0)]
            lo, hi = part.agg(F.percentile_approx(column, ends, _SKETCH_ACCURACY)).head()[0]
            inner = (v > F.lit(lo)) & (v < F.lit(hi))
            below, at_lo, between, at_hi = part.agg(
                F.count_if(v < F.lit(lo)), F.count_if(v == F.lit(lo)), F.count_if(inner),
                F.count_if(v == F.lit(hi)),
            ).head()
            if local < below:
                part, size = part.filter(v < F.lit(lo)), below
            elif local < below + at_lo:
                found[rank] = lo
            elif local < below + at_lo + between:
                part, local, size = part.filter(inner), local - below - at_lo, between
            elif lo == hi or local < below + at_lo + between + at_hi:
                if lo != hi:
                    found[rank] = hi
                else:
                    part, local, size = part.filter(v > F.lit(hi)), local - below - at_lo, size - below - at_lo
            else:
                gone = below + at_lo + between + at_hi
                part, local, size = part.filter(v > F.lit(hi)), local - gone, size - gone
    return found


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[str]) -> dict[str, float]:
    """Linearly interpolated quantiles; probabilities as decimal text ("0.9")."""
    n = df.select(F.count(column)).head()[0]
    if not n:
        return {}
    spots = {p: Fraction(p) * (n - 1) for p in probabilities}
    ranks = [r for s in spots.values() for r in (floor(s), ceil(s))]
    at = order_statistics(df, column, ranks, n)
    return {
        p: at[floor(s)] + (at[ceil(s)] - at[floor(s)]) * float(s - floor(s)) for p, s in spots.items()
    }
