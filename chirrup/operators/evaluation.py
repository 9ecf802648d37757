"""Classifier evaluation from a predictions table.

Every metric derives from the confusion counts (classes squared rows), which
one map-side combined aggregation yields; the steps after it are tiny.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.functions import text as X

TRUE, PRED = "true_label", "predicted_label"


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, prediction), for each group of `by`; a column `n` of `predictions` holds counts taken before."""
    n = F.sum("n") if "n" in predictions.columns else F.count(F.lit(1))
    return predictions.groupBy(*by, TRUE, PRED).agg(n.alias("n"))


def confusion_pairs(predictions: DataFrame) -> DataFrame:
    """Wrong pairs by frequency."""
    wrong = confusion_counts(predictions.filter(F.col(TRUE) != F.col(PRED)))
    return wrong.orderBy(F.desc("n"), TRUE, PRED)


def confusion_matrix(predictions: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Counts and row shares, one row per true class, one column per class."""
    wide = confusion_counts(predictions).groupBy(TRUE).pivot(PRED, list(classes)).agg(F.sum("n"))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"n_{c}") for c in classes]
    counted = wide.select(TRUE, *cells)
    support = sum((F.col(f"n_{c}") for c in classes), F.lit(0))
    counted = counted.withColumn("support", support)
    shares = [F.round(F.try_divide(f"n_{c}", "support"), 4).alias(f"share_{c}") for c in classes]
    return counted.select("*", *shares)


def class_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label seen in truth or prediction, for each group of `by`."""
    cells = confusion_counts(predictions, by)
    sides = F.array(
        F.struct(F.col(TRUE).alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col(PRED).alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when((F.col(TRUE) == F.col(PRED)), F.col("n")).otherwise(0)
    # a hit is counted on its truth side only
    long = cells.select(*by, hit.alias("hit"), F.posexplode(sides).alias("side", "s"))
    totals = long.groupBy(*by, F.col("s.label").alias("label")).agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("hits"),
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(2.0 * F.col("hits"), F.col("predicted") + F.col("support"))
    return totals.select(
        *by, "label", "support", "predicted", "hits", precision.alias("precision"), recall.alias("recall"), f1.alias("f1")
    )


def _ratio(a: Column, b: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def overall_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy with macro and support-weighted averages, as one row or one per group of `by`."""
    m = class_metrics(predictions, by)
    total = F.sum("support")
    aggs = [F.round(_ratio(F.sum("hits"), total), 4).alias("accuracy")]
    for name in ("precision", "recall", "f1"):
        aggs.append(F.round(F.avg(name), 4).alias(f"macro_{name}"))
        aggs.append(F.round(_ratio(F.sum(F.col(name) * F.col("support")), total), 4).alias(f"weighted_{name}"))
    return m.groupBy(*by).agg(total.alias("n"), *aggs)


def error_rates(predictions: DataFrame, by: str = TRUE) -> DataFrame:
    """Rows, errors and error rate per class or slice."""
    wrong = F.count_if(F.col(TRUE) != F.col(PRED))
    n = F.count(F.lit(1))
    return predictions.groupBy(by).agg(
        n.alias("n"), wrong.alias("errors"), F.round(100.0 * wrong / n, 1).alias("error_rate")
    )


def with_text_features(predictions: DataFrame, text: str = "text_clean") -> DataFrame:
    return predictions.select(
        "*",
        X.word_count(text).alias("word_count"),
        F.col(text).contains("@user").alias("has_user"),
        F.col(text).contains("#").alias("has_hashtag"),
        X.has_negation(text).alias("has_negation"),
        X.has_sarcasm(text).alias("has_sarcasm"),
    )


FEATURES = ("word_count", "has_user", "has_hashtag", "has_negation", "has_sarcasm")


def feature_deltas(featured: DataFrame, noticeable: float = 3.0) -> DataFrame:
    """Feature means of correct beside wrong rows, all features in one scan."""
    ok = F.col(TRUE) == F.col(PRED)
    aggs = []
    for f in FEATURES:
        v = F.col(f).cast("double") * (1 if f == "word_count" else 100)
        aggs.append(
            F.struct(
                F.lit(f).alias("feature"),
                F.round(F.avg(F.when(ok, v)), 2).alias("correct"),
                F.round(F.avg(F.when(~ok, v)), 2).alias("incorrect"),
            )
        )
    rows = featured.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    delta = F.round(F.col("incorrect") - F.col("correct"), 1)
    return rows.withColumn("delta", delta).withColumn(
        "meaningful", F.coalesce(F.abs(delta) >= noticeable, F.lit(False))
    )


def error_lift(featured: DataFrame, flag: str) -> DataFrame:
    """Error rate with and without a feature, and the lift in points."""
    wrong = (F.col(TRUE) != F.col(PRED)).cast("double") * 100
    rates = featured.agg(
        F.avg(F.when(F.col(flag), wrong)).alias("with_rate"), F.avg(F.when(~F.col(flag), wrong)).alias("without_rate")
    )
    return rates.select(
        F.lit(flag).alias("feature"),
        F.round("with_rate", 1).alias("with_rate"),
        F.round("without_rate", 1).alias("without_rate"),
        F.round(F.col("with_rate") - F.col("without_rate"), 1).alias("lift_pp"),
    )


# --------------------------------------------------------- trivial baselines
def majority_label(train: DataFrame, label: str) -> Column:
    """Most frequent label as a scalar subquery; ties by label."""
    counts = train.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), "_l").limit(1).select("_l").scalar()


def predict_majority(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    return rows.withColumn(PRED, majority_label(train, label))


def predict_stratified(train: DataFrame, rows: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Labels drawn with the training shares, by a uniform digest of the key.

    The cumulative shares are an array of as many entries as classes.
    """
    counts = train.groupBy(F.col(label).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, 0)
    shares = counts.select("name", (F.sum("n").over(upto) / F.sum("n").over(Window.partitionBy())).alias("upto"))
    ladder = shares.agg(F.array_sort(F.collect_list(F.struct("upto", "name"))).alias("l")).scalar()
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8)
    draw = F.conv(digits, 16, 10).cast("bigint") / F.lit(2.0**32)
    above = F.filter("_ladder", lambda s: s["upto"] > F.col("_draw"))
    drawn = rows.withColumn("_draw", draw).withColumn("_ladder", ladder)
    return drawn.withColumn(PRED, F.get(above, F.lit(0))["name"]).drop("_draw", "_ladder")


def beats_baselines(scores: DataFrame, trivial: Sequence[str]) -> DataFrame:
    """Each model's macro-F1 against the best trivial one (`model`, `macro_f1`)."""
    bar = scores.filter(F.col("model").isin(*trivial)).agg(F.max("macro_f1").alias("m")).scalar()
    return scores.filter(~F.col("model").isin(*trivial)).select(
        "model", "macro_f1", bar.alias("trivial_best"), (F.col("macro_f1") > bar).alias("passed")
    )
