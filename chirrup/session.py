"""Session settings and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "chirrup", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Shuffle parallelism is left to the cluster: AQE coalesces small partitions
    and splits skewed ones, so only local runs pin a partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """Session settings that hold inside of the block; the usual ones come back after it."""
    usual = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in usual.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in `spark.checkpoint.dir`. A machine-local folder is
    made up only in local mode, where driver and executors share one disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="chirrup-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet to the shared folder and read from there."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, spread_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder once and read it from there afterwards.

    Used before multi-pass work (model fits): a lost executor then costs a
    re-read of files instead of a recomputation of the text features. With
    `spread_by`, rows are hashed over at least one partition per core first, so
    a table that is small in bytes but heavy in text work uses every core.
    """
    spark = df.sparkSession
    if spread_by:
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(max(spark.sparkContext.defaultParallelism, shuffle), spread_by)
    root = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)
