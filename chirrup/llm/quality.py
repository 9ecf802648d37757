"""Quality classifier: averaged subword embeddings with a softmax output, trained by stochastic gradient descent.

A document is the mean of learned vectors of its hashed words, hashed character
n-grams and hashed word-to-word steps. Training runs in numpy on a bounded sample of labelled
rows; since the output is linear in the mean, scoring needs one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import Words, mix64, slices

BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
DIM, EPOCHS, RATE = 16, 5, 2.0

_U = np.uint64


def flat(text: Column) -> Column:
    """The text with runs of white space as one space; null is empty. Case and punctuation stay."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) arrays: words, word steps, then each size of byte n-gram."""
    words = Words(column)
    every = np.arange(len(words.start))
    h = words.hashed(every, every) if len(every) else np.zeros(0, _U)
    yield words.doc, (h % _U(BUCKETS)).astype(np.int64)
    step = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    same = h[step] == h[step + 1]  # a repeated word is one feature, whatever the word
    pair = np.where(same, _U(1), mix64(h[step] * _U(3) + h[step + 1]))
    yield words.doc[step], (mix64(pair) % _U(BUCKETS)).astype(np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0] : offs[-1]].astype(_U) if raw is not None else np.zeros(0, _U)
    doc = np.repeat(np.arange(len(column)), np.diff(offs))
    for size in GRAMS:
        if len(data) < size:
            continue
        code = np.full(len(data) - size + 1, size, _U)
        for i in range(size):
            code = (code << _U(8)) | data[i : len(data) - size + 1 + i]
        inside = doc[: len(code)] == doc[size - 1 :]
        yield doc[: len(code)][inside], (mix64(code[inside]) % _U(BUCKETS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "flat"):
            parts = list(features(batch.column("flat")))
            key = np.sort(np.concatenate([(d << 17) | b for d, b in parts]))
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate((first, [len(key)])))
            doc = key[first] >> 17
            offs = np.searchsorted(doc, np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.ListArray.from_arrays(pa.array(offs), pa.array((key[first] & (BUCKETS - 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(n.astype(np.float32)))], ["y", "ids", "n"])


def train(sample: DataFrame, counts: dict[int, int], seed: int = 7) -> np.ndarray:
    """One score per bucket and the offset (last), from sample(text, y) by gradient descent.

    Classes are weighted to their shares among all allowed labels. Without rows of
    both classes the model is the offset alone.
    """
    rows = (sample.select("y", flat(F.col("text")).alias("flat")).mapInArrow(_counts, "y int, ids array<int>, n array<float>")).toArrow()
    y = rows.column("y").to_numpy().astype(float)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1.0) / (total + 2.0)
    model = np.zeros(BUCKETS + 1)
    if len(set(y)) < 2:
        model[-1] = np.log(prior / (1 - prior))
        return model
    ids = [np.asarray(x.values) for x in rows.column("ids")]
    n = [np.asarray(x.values, np.float32) for x in rows.column("n")]
    share = np.array([(1 - prior) / max(1, (y == 0).sum()), prior / max(1, (y == 1).sum())]) * len(y)
    order = np.argsort(mix64(np.array([len(i) for i in ids], _U) + mix64(np.array([i[:64].sum() if len(i) else 0 for i in ids], _U))), kind="stable")
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((2, DIM), np.float32)
    bias = np.zeros(2, np.float32)
    done, steps = 0, EPOCHS * len(y)
    for _ in range(EPOCHS):
        for k in order[rng.permutation(len(order))]:
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(ids[k]):
                continue
            w = n[k] / n[k].sum()
            hidden = w @ vectors[ids[k]]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            err = -p
            err[int(y[k])] += 1
            err *= min(share[int(y[k])], 5.0)
            back = err @ out
            out += rate * np.outer(err, hidden)
            bias += 0.1 * rate * err
            vectors[ids[k]] += (rate * np.minimum(w * 64, 1.0))[:, None] * back
    model[:-1] = vectors @ (out[1] - out[0])
    model[-1] = bias[1] - bias[0]
    return model


def score(docs: DataFrame, model: np.ndarray, *keep: str) -> DataFrame:
    """`keep` columns with `score`, the probability of label 1 from the whole text.

    Null and empty texts have no feature and get the model's offset.
    """
    table = model[:-1].astype(np.float32)
    offset = float(model[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "flat"):
                total, n = np.zeros(len(batch)), np.zeros(len(batch))
                for doc, bucket in features(batch.column("flat")):
                    total += np.bincount(doc, weights=table[bucket], minlength=len(batch))
                    n += np.bincount(doc, minlength=len(batch))
                z = total / np.maximum(n, 1) + offset
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(1 / (1 + np.exp(-z)))], [*keep, "score"])

    source = docs.select(*keep, flat(F.col("text")).alias("flat"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields)
    return source.mapInArrow(run, f"{fields}, score double")
