"""Structured Streaming forms: tumbling timeline, merge by key, late guards."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from chirrup.operators.timeline import fill_hours, timeline_measures
from chirrup.session import fresh_dir
from chirrup.sources.collect import merge_first_seen
from chirrup.streaming.store import bucket_of, compact, read_store, write_batch


def read_posts(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A given table as a file stream (a single file or a folder of files).

    The glob keeps the source from taking a lone file for a base folder.
    """
    schema = schema or spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def split_future(stream: DataFrame, created: str = "ts", collected: str = "collected") -> tuple[DataFrame, DataFrame]:
    """Ordinary posts and posts dated after their collection.

    A single future-dated row would move the watermark and make real rows late,
    so flagged rows take their own path before any watermark.
    """
    future = F.coalesce(F.col(created) > F.col(collected), F.lit(False))
    return stream.filter(~future), stream.filter(future)


MEASURES = ("post_count", "total_engagement", "n_negative", "n_positive")


def hourly_counts(posts: DataFrame, ts: str = "ts", series: Sequence[str] = ()) -> DataFrame:
    """Counts per tumbling hour of one batch."""
    label = F.col("sentiment_label")
    return (
        posts.groupBy(F.window(F.col(ts).cast("timestamp"), "1 hour").alias("window"), *series)
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.sum("engagement").alias("total_engagement"),
            F.count_if(label == "Negative").alias("n_negative"),
            F.count_if(label == "Positive").alias("n_positive"),
        )
        .select(F.col("window.start").alias("hour"), *series, *MEASURES)
    )


def run_name(checkpoint: str) -> str:
    """The name under which a checkpoint's batches are stored; replays of one checkpoint agree."""
    return "r" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def start_hourly(stream: DataFrame, path: str, checkpoint: str, ts: str = "ts", series: Sequence[str] = ()) -> StreamingQuery:
    """Store each batch's hour counts; a replayed batch overwrites its own folder.

    Counts add up, so rows of any age are merged when the table is read, and
    the last hours are there before they close. There is no watermark and no state.
    """
    run = run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(hourly_counts(batch, ts, series), path, run, batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _hourly_schema(series: Sequence[str]) -> str:
    return ", ".join(["hour timestamp", *(f"{s} string" for s in series), *(f"{m} bigint" for m in MEASURES)])


def _summed(counts: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return counts.groupBy("hour", *series).agg(*[F.sum(m).alias(m) for m in MEASURES])


def read_hourly(spark: SparkSession, path: str, series: Sequence[str] = ()) -> DataFrame:
    """Hour counts over all stored batches."""
    return _summed(read_store(spark, path, _hourly_schema(series)), series)


def compact_hourly(spark: SparkSession, path: str, checkpoint: str, series: Sequence[str] = (), over: bool = False) -> None:
    """Replace a run's batches by their sums, so the table has a row per hour and series again.

    `over` says that the run will not continue, so that its last batch is summed too.
    """
    compact(spark, path, run_name(checkpoint), _hourly_schema(series), lambda df: _summed(df, series), before_last=not over)


def read_timeline(spark: SparkSession, path: str, series: Sequence[str] = ()) -> DataFrame:
    """The full timeline of the stored counts: averages, percentages, and zero rows for empty hours."""
    counts = read_hourly(spark, path, series).withColumn("n_neutral", F.col("post_count") - F.col("n_negative") - F.col("n_positive"))
    return timeline_measures(fill_hours(counts, series), series)


def first_ever(stream: DataFrame, key: str) -> DataFrame:
    """First arrival per key, however late a copy comes; the state holds every key.

    Where keys outgrow the state store, `start_merge` keeps them in a bucketed table.
    """
    return stream.dropDuplicates([key])


def first_within_watermark(stream: DataFrame, key: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First arrival per key while the key is within the watermark horizon; rows later than that are dropped."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def start_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet folder; file sink and checkpoint give exactly-once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


BUCKETS = 256  # folders of keys in a merged table


def merge_batch(path: str, key: str, arrival: str, run: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` writer keeping the first row per key over all batches and runs.

    Only keys not stored yet are appended, without any time horizon. The table
    is bucketed by key hash, and a batch reads the key column of its own buckets
    only. It goes to its own folder, overwritten when the batch is replayed, and
    is compared with the earlier batches of its run and with all other runs; a
    replay thus gives the same rows, and a new checkpoint on a stored table
    adds to it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        unique = merge_first_seen(batch.limit(0), batch, key, arrival).drop("is_new").withColumn("bucket", bucket_of(key, buckets)).persist()
        touched = [r.bucket for r in unique.select("bucket").distinct().collect()]  # `buckets` numbers at most
        stored = read_store(spark, path, batch.schema, True, lambda r, b: r != run or b < batch_id)
        earlier = stored.filter(F.col("bucket").isin(touched)).select(key)
        write_batch(unique.join(earlier, key, "left_anti").repartition("bucket"), path, run, batch_id, ["bucket"])
        unique.unpersist()

    return write


def start_merge(
    stream: DataFrame, path: str, checkpoint: str, key: str = "post_uri", arrival: str = "arrival", buckets: int = BUCKETS,
) -> StreamingQuery:
    """Merge the stream into the table at `path`; the number of buckets must stay as the table was begun."""
    return (
        stream.writeStream.foreachBatch(merge_batch(path, key, arrival, run_name(checkpoint), buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_merged(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_store(spark, path, schema, True).drop("run", "batch", "bucket")


def compact_merged(spark: SparkSession, path: str, checkpoint: str, schema, over: bool = False) -> None:
    """One file per bucket in place of one per bucket and batch of a run."""
    compact(spark, path, run_name(checkpoint), schema, before_last=not over, buckets=True)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Drain the available input into a new table of the shared folder."""
    spark = stream.sparkSession
    root = fresh_dir(spark, name)
    start_to_table(stream, f"{root}/rows", f"{root}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def run_merge(stream: DataFrame, name: str, key: str = "post_uri", arrival: str = "arrival") -> DataFrame:
    spark = stream.sparkSession
    root = fresh_dir(spark, name)
    start_merge(stream, f"{root}/rows", f"{root}/state", key, arrival).awaitTermination()
    return read_merged(spark, f"{root}/rows", stream.schema)


def run_hourly(stream: DataFrame, name: str) -> DataFrame:
    root = fresh_dir(stream.sparkSession, name)
    start_hourly(stream, f"{root}/rows", f"{root}/state").awaitTermination()
    return read_hourly(stream.sparkSession, f"{root}/rows")


def run_timeline(stream: DataFrame, name: str) -> DataFrame:
    """Drain the input, compact the stored counts, and read them as a full timeline."""
    spark = stream.sparkSession
    root = fresh_dir(spark, name)
    start_hourly(stream, f"{root}/rows", f"{root}/state").awaitTermination()
    compact_hourly(spark, f"{root}/rows", f"{root}/state", over=True)
    return read_timeline(spark, f"{root}/rows")
