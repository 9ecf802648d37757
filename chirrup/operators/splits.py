"""Leak-free splits and checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chirrup.operators.ranking import positions_in_strata, seeded_key
from chirrup.params import SplitParams


def group_split(
    df: DataFrame, text: str = "text_clean", label: str = "sentiment_label", key: str = "text_id",
    params: SplitParams = SplitParams(),
) -> DataFrame:
    """Add `split` so that all rows of one text land in the same part.

    Groups are stratified by the label of their first row (lowest key). Texts
    are represented by digests, so only short fixed-width keys are shuffled to
    find the cut; the text itself moves once, to meet its group's part. Rows
    without text are one group, so the parts add up to the input.
    """
    digests = df.withColumn("_group", F.coalesce(F.sha2(text, 256), F.lit("no text"))).withColumn(
        "_order", F.coalesce(seeded_key(F.col(text), params.seed), F.lit("")))
    groups = digests.groupBy("_group", "_order").agg(F.min_by(label, key).alias("_label"))
    ranked = positions_in_strata(groups, "_label", "_order", "_group")
    n = F.col("stratum_size")

    def part(share: float):
        return F.greatest(F.lit(1), F.bround(n * F.lit(share)).cast("bigint"))

    n_train = n - part(params.val_share) - part(params.test_share)
    split = (
        F.when(F.col("position") <= n_train, "train")
        .when(F.col("position") <= n_train + part(params.val_share), "val")
        .otherwise("test")
    )
    return digests.join(ranked.select("_group", split.alias("split")), "_group").drop("_group", "_order")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: int = 42) -> DataFrame:
    """Row-level stratified split in two, for diagnostics."""
    keyed = df.withColumn("_order", seeded_key(F.col(key), seed))
    ranked = positions_in_strata(keyed, label, "_order", key)
    n_test = F.greatest(F.lit(1), F.bround(F.col("stratum_size") * F.lit(test_share)).cast("bigint"))
    in_train = F.col("position") <= F.col("stratum_size") - n_test
    return ranked.withColumn("split", F.when(in_train, "train").otherwise("test")).drop(
        "_order", "position", "stratum_size"
    )


def split_leaks(split: DataFrame, text: str = "text_clean") -> DataFrame:
    """Texts found in more than one part (must be none)."""
    return (
        split.groupBy(F.sha2(text, 256).alias("text_digest"))
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def split_sizes(split: DataFrame, label: str = "sentiment_label") -> DataFrame:
    return split.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
