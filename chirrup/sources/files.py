"""File and table sources and sinks, and named SQL over views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RAW_USERS = ("user_id", "location", "language", "account_created", "follower_count")
RAW_POSTS = ("post_id", "user_id", "platform", "text_content", "timestamp", "likes", "shares", "comments")
CLEAN_POSTS = (
    "post_id", "user_id", "platform", "text_content", "timestamp_raw", "event_time",
    "likes", "shares", "comments",
)
LABELLED_TEXTS = ("text_id", "post_text", "sentiment_label", "topic_category")

USERS_SCHEMA = "user_id string, location string, language string, account_created date, follower_count bigint"
POSTS_SCHEMA = (
    "post_id string, user_id string, platform string, text_content string, timestamp_raw string, "
    "event_time timestamp_ntz, likes bigint, shares bigint, comments bigint"
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV with every column as text; doubled quotes, line breaks in quotes.

    A quoted line break makes a file unsplittable, so pass `multi_line=False`
    for large files known to hold one record per line.
    """
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed Parquet scan; the schema is stated, never inferred."""
    return spark.read.schema(schema).parquet(path)


def write_table(
    df: DataFrame, path: str, columns: Sequence[str], partition_by: str | None = None, replace: str = "table", sort_by: Sequence[str] = (),
) -> None:
    """Write in a fixed column order; `partition_by` is a low-cardinality column.

    Rows are rebalanced by the partition column: tasks, and so files, have
    about the advisory partition size. A hot month is split over as many files
    as it needs and a small one stays in one, unless it shares its hash
    partition with a hot one. `sort_by` orders rows inside a
    file, for tight value ranges in its footers. With `replace="partitions"`
    only the partitions present in `df` are replaced, so a month can be loaded
    again any number of times; "table" replaces everything.
    """
    if replace not in ("table", "partitions"):
        raise ValueError(f"replace is 'table' or 'partitions', not {replace!r}")
    names = [*columns, *([partition_by] if partition_by else [])]
    out = df.select(*names)
    if not partition_by:
        if replace == "partitions":
            raise ValueError("a table without partitions is replaced as a whole")
        (out.sortWithinPartitions(*sort_by) if sort_by else out).write.mode("overwrite").parquet(path)
        return
    out = out.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_by)
    mode = "dynamic" if replace == "partitions" else "static"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make DataFrames available to SQL text; re-registering replaces them."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def load_tables(spark: SparkSession, frames: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Idempotent load: write each table, register it, compare row counts.

    Counts are taken while writing (observed metrics) and again from the
    written files' footers, so the check does not recompute the input.
    """
    from pyspark.sql import Observation

    checks = []
    for name, df in frames.items():
        seen = Observation(f"load_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        stored = spark.read.schema(df.schema).parquet(f"{root}/{name}")
        stored.createOrReplaceTempView(name)
        checks.append(
            stored.agg(F.count(F.lit(1)).alias("stored_rows")).select(
                F.lit(name).alias("table_name"), F.lit(seen.get["n"]).cast("bigint").alias("source_rows"), "stored_rows"
            )
        )
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("passed", F.col("source_rows") == F.col("stored_rows"))


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text; frames are passed as `{name}` placeholders, not globals."""
    return spark.sql(text, **(views or {}))
