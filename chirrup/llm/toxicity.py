"""Toxicity classifier with counterfactual regularisation.

A logistic model over the hashed words and byte 4-grams that occur in a text. For every labelled
text that names a group, each swap of the group's name for another of the same kind is a
counterfactual: the swapped text is built and hashed like the text itself, and the squared
change of the model's output over all features and swaps is part of the loss,
so neither a group's name nor its 4-grams move the score alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import Words, mix64, plain, slices

BUCKETS = 1 << 20
GRAM = 4
EVIDENCE = 15.0  # log-likelihood ratio between the classes that a feature must show in the sample
ROUNDS, RATE, RIDGE, SWAP = 300, 0.3, 5e-5, 1.0

# Names of groups, by kind; a swap stays within its kind.
IDENTITIES = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "hispanic"),
    ("immigrants", "refugees", "natives", "locals", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "elderly", "young", "old"),
)

_U = np.uint64


def _word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the distinct words and byte n-grams of each text."""
    words = Words(column)
    every = np.arange(len(words.start))
    if not len(every):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = (words.doc << 20) | (words.hashed(every, every) % _U(BUCKETS)).astype(np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offs[0] : offs[-1]].astype(np.uint32)
    if len(data) >= GRAM:
        code = np.zeros(len(data) - GRAM + 1, np.uint32)
        for i in range(GRAM):
            code = (code << np.uint32(8)) | data[i : len(data) - GRAM + 1 + i]
        doc = np.repeat(np.arange(len(column)), np.diff(offs))
        inside = doc[: len(code)] == doc[GRAM - 1 :]
        grams = (mix64(code[inside].astype(_U)) >> _U(44)).astype(np.int64)
        key = np.concatenate((key, (doc[: len(code)][inside] << 20) | grams))
    key = np.sort(key)
    key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return key >> 20, key & (BUCKETS - 1)


def name_bucket(word: str) -> int:
    """The bucket of a whole word."""
    words = Words(pa.array([word]))
    return int(words.hashed(np.zeros(1, np.int64), np.zeros(1, np.int64))[0] % _U(BUCKETS))


def evidence(held: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each feature: held[c] of rows[c] texts of class c hold it."""
    def entropy(k: np.ndarray, n: float) -> np.ndarray:
        p = k / n
        return k * np.log(np.maximum(p, 1e-12)) + (n - k) * np.log(np.maximum(1 - p, 1e-12))

    return 2 * (entropy(held[0], rows[0]) + entropy(held[1], rows[1]) - entropy(held[0] + held[1], rows.sum()))


def swapped(text: str, ids: np.ndarray, identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(share, features the swap takes away, features it adds) of each swap of a group's name; the swaps of a name share 1."""
    out = []
    words = text.split(" ")
    held = set(words)
    for kind in identities:
        for name in kind:
            if name in held:
                for other in kind:
                    if other != name:
                        new = np.unique(_word_ids(pa.array([" ".join(other if w == name else w for w in words)]))[1])
                        out.append((1 / (len(kind) - 1), np.setdiff1d(ids, new), np.setdiff1d(new, ids)))
    return out


_SETS = "y int, ids array<int>, swaps array<struct<share:double,gone:array<int>,new:array<int>>>"


def _sets(identities: tuple[tuple[str, ...], ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("share", pa.float64()), ("gone", pa.list_(pa.int32())), ("new", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "plain"):
                doc, ids = _word_ids(batch.column("plain"))
                offs = np.searchsorted(doc, np.arange(len(batch) + 1)).astype(np.int32)
                swaps = [[{"share": n, "gone": gone.astype(np.int32), "new": new.astype(np.int32)} for n, gone, new in swapped(text.as_py(), ids[i:j], identities)]
                         for text, i, j in zip(batch.column("plain"), offs[:-1], offs[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y"), pa.ListArray.from_arrays(pa.array(offs), pa.array(ids.astype(np.int32))), pa.array(swaps, kind)], ["y", "ids", "swaps"])

    return run


def _changes(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(swap, feature, sign) of what every swap takes away (1) and adds (-1), and the share of each swap."""
    every = rows.column("swaps").combine_chunks().flatten()
    swap, feature, sign = [], [], []
    for name, side in (("gone", 1.0), ("new", -1.0)):
        lists = every.field(name)
        values = lists.flatten().to_numpy().astype(np.int64)
        swap.append(np.repeat(np.arange(len(every)), lists.value_lengths().to_numpy()))
        feature.append(values)
        sign.append(np.full(len(values), side))
    return np.concatenate(swap), np.concatenate(feature), np.concatenate(sign), every.field("share").to_numpy()


def train(sample: DataFrame, counts: dict[int, int], swap: float = SWAP, identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> np.ndarray:
    """One weight per bucket and the offset (last), from sample(text, y).

    Classes are weighted to their shares among all allowed labels. Without rows of
    both classes the model is the offset alone.
    """
    rows = sample.select("y", plain(F.col("text")).alias("plain")).mapInArrow(_sets(identities), _SETS).toArrow()
    y = rows.column("y").to_numpy().astype(float)
    prior = (counts.get(1, 0) + 1.0) / (sum(counts.values()) + 2.0)
    model = np.zeros(BUCKETS + 1)
    model[-1] = np.log(prior / (1 - prior))
    if len(set(y)) < 2:
        return model
    lists = rows.column("ids").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    ids, doc = lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(y)), size)
    of, changed, sign, n = _changes(rows)
    held = np.array([np.bincount(ids[y[doc] == c], minlength=BUCKETS) for c in (0, 1)], float)
    common = evidence(held, np.array([(y == 0).sum(), (y == 1).sum()], float)) >= EVIDENCE
    common[changed] = True
    ok = common[ids]
    ids, doc = ids[ok], doc[ok]
    weight = np.where(y == 1, prior / (y == 1).sum(), (1 - prior) / (y == 0).sum())
    used = np.flatnonzero(common)
    place = np.zeros(BUCKETS, np.int64)
    place[used] = np.arange(len(used))
    ids, changed, n = place[ids], place[changed], swap * n / len(y)
    w, b, past = np.zeros(len(used)), model[-1], np.full(len(used), 1e-6)
    past_b = 1e-6
    for _ in range(ROUNDS):
        z = np.bincount(doc, weights=w[ids], minlength=len(y)) + b
        err = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        grad = np.bincount(ids, weights=err[doc], minlength=len(used)) + RIDGE * w
        if len(changed):
            gap = 2 * n * np.bincount(of, weights=sign * w[changed], minlength=len(n))
            grad += np.bincount(changed, weights=sign * gap[of], minlength=len(used))
        past += grad * grad
        past_b += err.sum() ** 2
        w -= RATE * grad / np.sqrt(past)
        b -= RATE * err.sum() / np.sqrt(past_b)
    model[used], model[-1] = w, b
    return model


def toxic_score(model: np.ndarray, text: Column) -> Column:
    """Probability of label 1 from the whole text; null and empty texts get the model's offset."""
    table, offset = model[:-1].astype(np.float32), float(model[-1])
    some = np.flatnonzero(table)
    values = table[some]

    def run(texts: pa.Array) -> pa.Array:
        full = np.zeros(BUCKETS, np.float32)
        full[some] = values
        out = []
        for batch in slices(pa.RecordBatch.from_arrays([texts], ["plain"]), "plain"):
            doc, ids = _word_ids(batch.column("plain"))
            z = np.bincount(doc, weights=full[ids], minlength=len(batch)) + offset
            out.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(run, "double")(plain(text))
