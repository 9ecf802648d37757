"""Shared pieces: word normalisation, durable cuts, size-checked broadcasts, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chirrup.session import fresh_dir

WIDTH = 5  # words in a shingle
SIMILAR = 0.8
BROADCAST_BYTES = 32 << 20
TEXT_ROWS = 1000  # whole texts that Python steps get at a time

_U = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(text: Column) -> Column:
    """Lower case, runs of anything but letters, marks and digits as one space; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))


PLAIN_SQL = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))"


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    if 0 < int(usual) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """`df` written as Parquet to the shared folder and read from there: smaller than a checkpoint for long texts.

    With `rows`, the Python steps in it get at most so many rows at a time, which bounds what a batch of texts takes.
    """
    path = fresh_dir(df.sparkSession, name)
    with nullcontext() if rows is None else _batches_of(df.sparkSession, rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows fit `limit`; otherwise the join shuffles.

    `df` must be cheap to count (a checkpointed or tiny table).
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def without(docs: DataFrame, drop: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of `docs` whose `keys` (name in `drop` -> expression on docs) are not in `drop`; nulls match nulls."""
    return _filtered(docs, drop, keys, "left_anti")


def only(docs: DataFrame, keep: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of `docs` whose `keys` are in `keep`; nulls match nulls."""
    return _filtered(docs, keep, keys, "left_semi")


def _filtered(docs: DataFrame, other: DataFrame, keys: dict[str, Column], how: str) -> DataFrame:
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         *[e.alias(f"_k_{n}") for n, e in keys.items()])
    other = other.select(*[F.col(n).alias(f"_o_{n}") for n in keys])
    on = [F.col(f"_k_{n}").eqNullSafe(F.col(f"_o_{n}")) for n in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return packed.join(other, cond, how).select("_row.*")


# ---- words of an Arrow batch, as numpy arrays ---------------------------------------------------

_MULT = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _MULT), ("down", _INV)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=_U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in row runs of about `most` text bytes; a longer text stands alone."""
    column = batch.column(text)
    if not len(column):
        return
    sizes = np.asarray(pc.binary_length(column).fill_null(0), np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    yield batch.slice(start)


class Words:
    """Word spans of a string column that `plain` has normalised, and hashes of spans."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("")
        if pa.types.is_large_string(column.type):
            offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        else:
            offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offs[0] : offs[-1]] if raw is not None else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        space = data == 32
        before = np.concatenate(([True], space))[:n] | edge[:n]
        after = np.concatenate((space[1:], [True]))[:n] | edge[1:]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.doc = np.searchsorted(offs[1:], self.start, side="right")
        self.docs = len(column)
        up, down = _powers(n + 1)
        self._sum = np.zeros(n + 1, _U)
        if n:
            np.cumsum(_BYTE[data] * up[:n], out=self._sum[1:])
        self._down = down

    def hashed(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span from word `first` to word `last`, both included."""
        s, e = self.start[first], self.end[last]
        return mix64((self._sum[e] - self._sum[s]) * self._down[s])

    def shingles(self, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of every shingle in order; a shorter text is one shingle."""
        n = np.bincount(self.doc, minlength=self.docs)
        first_word = np.concatenate(([0], np.cumsum(n)[:-1]))
        count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
        doc = np.repeat(np.arange(self.docs), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = first_word[doc] + at
        return doc, self.hashed(first, first + np.minimum(n[doc], width) - 1)


# ---- connected components -----------------------------------------------------------------------

def _written(df: DataFrame) -> DataFrame:
    return stored(df, "components")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each component of `edges(a, b)`.

    Every round takes the smallest label among neighbours and then jumps to the
    label's own label, so star-shaped groups settle in two or three rounds. Each
    round is written to the shared folder; only one number comes back to the driver.
    """
    both = _written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = _written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("label")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        stepped = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = _written(stepped.join(roots, "label").select("node", "old", F.least("label", "root").alias("label")))
        if not jumped.where(F.col("old") != F.col("label")).limit(1).count():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
