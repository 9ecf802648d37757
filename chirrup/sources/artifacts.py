"""Label maps and predictions on storage; fitted models are stored by `operators.scoring`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chirrup.params import LABEL_CODES


def label_table(spark: SparkSession, codes: dict[str, dict[str, int]] = LABEL_CODES) -> DataFrame:
    """Label names and ids of every label column as rows."""
    rows = [(field, name, i) for field, names in codes.items() for name, i in names.items()]
    return spark.createDataFrame(rows, "field string, label string, label_id bigint")


def save_label_table(labels: DataFrame, path: str) -> None:
    labels.coalesce(1).write.mode("overwrite").json(path)


def load_label_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("field string, label string, label_id bigint").json(path)


def predictions_table(scored: DataFrame) -> DataFrame:
    return scored.select(
        "text_id", "text_clean", "true_label", "predicted_label",
        (F.col("true_label") == F.col("predicted_label")).alias("correct"),
    )


def save_predictions(scored: DataFrame, path: str) -> None:
    predictions_table(scored).write.mode("overwrite").parquet(path)
