"""A table that streams write batch by batch, with replays, restarts and compaction.

Layout: `run=<name>/batch=<id>/[bucket=<b>/]` under one folder. A batch replaces its own folder, so a
replay changes nothing. Compaction combines a run's folders up to some id into one folder with a
negative id, `-(id + 1)`; a reader takes the newest finished compaction of a run and the batches after
it, so a crash before or after the old folders are removed changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def batch_folder(path: str, run: str, batch: int) -> str:
    return f"{path}/run={run}/batch={batch}"


def _listed(spark: SparkSession, folder: str, prefix: str, done: bool = False) -> list[str]:
    """Values of the folders `prefix=value` below `folder`; with `done`, of finished writes only."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    names = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(place) if s.isDirectory()]
    return [n.removeprefix(prefix) for n, p in names
            if n.startswith(prefix) and (not done or fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))]


def valid_batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The batch ids to read of each run: the newest compaction, if any, and the finished batches after it."""
    out = {}
    for run in sorted(_listed(spark, path, "run=")):
        ids = sorted(int(b) for b in _listed(spark, f"{path}/run={run}", "batch=", done=True))
        newest = min((i for i in ids if i < 0), default=None)
        after = -1 if newest is None else -newest - 1
        out[run] = ([] if newest is None else [newest]) + [i for i in ids if i > after]
    return out


def read_store(spark: SparkSession, path: str, schema, buckets: bool = False, keep: Callable[[str, int], bool] | None = None) -> DataFrame:
    """Rows of all valid batches, with `run` and `batch` (and `bucket`, which prunes folders when filtered on)."""
    folders = [batch_folder(path, run, b) for run, ids in valid_batches(spark, path).items() for b in ids if keep is None or keep(run, b)]
    extra = "run string, batch int" + (", bucket int" if buckets else "")
    full = spark.createDataFrame([], schema).limit(0).schema
    for f in spark.createDataFrame([], extra).schema:
        full = full.add(f)
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def write_batch(df: DataFrame, path: str, run: str, batch: int, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(batch_folder(path, run, batch))


def compact(
    spark: SparkSession, path: str, run: str, schema, combine: Callable[[DataFrame], DataFrame] = lambda df: df,
    before_last: bool = True, buckets: bool = False,
) -> None:
    """Combine a run's batches into one folder and remove what it replaces.

    The last batch is left as it is, because a restarted stream may write it
    again; `before_last=False` takes it too, for runs that are over.
    """
    ids = valid_batches(spark, path).get(run, [])
    old = [i for i in ids if i >= 0]
    upto = (old[-2] if len(old) > 1 else None) if before_last else (old[-1] if old else None)
    if upto is not None:
        rows = read_store(spark, path, schema, buckets, lambda r, b: r == run and (b < 0 or b <= upto)).drop("run", "batch")
        made = combine(rows)
        write_batch(made.repartition("bucket") if buckets else made, path, run, -(upto + 1), ["bucket"] if buckets else ())
    # folders that a finished compaction covers, also those a crash left behind
    newest = min((int(b) for b in _listed(spark, f"{path}/run={run}", "batch=", done=True) if int(b) < 0), default=0)
    if newest < 0:
        for b in _listed(spark, f"{path}/run={run}", "batch="):
            if newest < int(b) < -newest:
                place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(batch_folder(path, run, int(b)))
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
