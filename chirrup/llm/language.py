"""Language identification as a mixture of languages per document.

Each language is a distribution over hashed byte n-grams of lower-case letters,
counted over all training texts. Expectation-maximisation finds a document's
language proportions; languages leave the set, smallest proportion first, as long as the
log-likelihood falls by less than the penalty for a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import mix64, slices

GRAM = 3
BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 3.0  # times the logarithm of the document's n-grams, per language

_U = np.uint64


def letters(text: Column) -> Column:
    """Lower-case letters, other runs as one space, padded by spaces; empty without a letter."""
    kept = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " "))
    return F.when(F.regexp_like(kept, F.lit(r"\p{L}")), F.concat(F.lit(" "), kept, F.lit(" "))).otherwise(F.lit(""))


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every byte n-gram that lies within one text."""
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0] : offs[-1]].astype(_U) if raw is not None else np.zeros(0, _U)
    offs = offs - offs[0]
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(len(data) - GRAM + 1, _U)
    for i in range(GRAM):
        code = (code << _U(8)) | data[i : len(data) - GRAM + 1 + i]
    doc = np.repeat(np.arange(len(column)), np.diff(offs))
    same = doc[: len(code)] == doc[GRAM - 1 :]
    return doc[: len(code)][same], (mix64(code[same]) >> _U(48)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for whole in batches:
        for batch in slices(whole, "letters"):
            doc, gram = _grams(batch.column("letters"))
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                mine = langs == lang
                held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                held[lang] += np.bincount(gram[mine[doc]], minlength=BUCKETS)
    for lang, n in held.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "gram", "n"])


def learn(train: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities) from train(text, lang); rows without a language or a letter are left out.

    Counts are summed inside each partition first. What reaches the driver is the model:
    at most 65,536 numbers for each language, whatever the size of the corpus.
    """
    rows = train.where("lang is not null").select("lang", letters(F.col("text")).alias("letters")).where("letters != ''")
    counts = rows.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    for i, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[i, own["gram"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)) if langs else table


def _unique(doc: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.sort((doc << 16) | gram)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first] >> 16, key[first] & (BUCKETS - 1), np.diff(np.concatenate((first, [len(key)]))).astype(float)


def _fit(p: np.ndarray, n: np.ndarray, start: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of documents under the allowed languages."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(n, start)[:, None]
    for _ in range(ROUNDS):
        joint = p * share[doc]
        joint *= (n / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, start, axis=0) / total
    return share, np.add.reduceat(n * np.log((p * share[doc]).sum(axis=1)), start)


def proportions(doc: np.ndarray, gram: np.ndarray, docs: int, logp: np.ndarray) -> np.ndarray:
    """(docs, languages) proportions after selection; rows without n-grams are 0.

    Work is per distinct n-gram of a document. Probabilities are scaled by the
    best language of each n-gram, which changes no comparison.
    """
    out = np.zeros((docs, len(logp)))
    if not len(doc):
        return out
    doc, gram, n = _unique(doc, gram)
    ids, start = np.unique(doc, return_index=True)
    local = np.repeat(np.arange(len(ids)), np.diff(np.concatenate((start, [len(doc)]))))
    p = np.exp(logp[:, gram] - logp[:, gram].max(axis=0)).T
    allowed = np.ones((len(ids), len(logp)))
    share, like = _fit(p, n, start, local, allowed)
    penalty = PENALTY * np.log(np.maximum(np.add.reduceat(n, start), 2.0))
    live = np.arange(len(ids))
    best = share
    while True:
        # The next smaller set of every document that still holds two languages.
        live = live[(allowed[live] > 0).sum(axis=1) > 1]
        if not len(live):
            break
        sizes = np.where(allowed[live] > 0, best[live], np.inf)
        tiny = (sizes < 0.01) & (sizes < best[live].max(axis=1, keepdims=True))
        smallest = np.zeros_like(tiny)
        smallest[np.arange(len(live)), sizes.argmin(axis=1)] = True
        removed = tiny | smallest
        trial = allowed[live] * ~removed
        mine = np.zeros(len(ids), bool)
        mine[live] = True
        rows = mine[local]
        back = np.searchsorted(live, local[rows])
        first = np.flatnonzero(np.concatenate(([True], back[1:] != back[:-1])))
        new, new_like = _fit(p[rows], n[rows], first, back, trial)
        better = new_like + penalty[live] * removed.sum(axis=1) >= like[live]
        won = live[better]
        allowed[won], best[won], like[won] = trial[better], new[better], new_like[better]
        live = won
    out[ids] = best
    return out


def identify(docs: DataFrame, langs: list[str], logp: np.ndarray, *keep: str) -> DataFrame:
    """`keep` columns with lang_pred, score, langs and shares.

    lang_pred is the language with the largest proportion and score that
    proportion; `langs` and `shares` hold the selected set, largest first. A null
    text, one without a letter, and one too short for an n-gram give `und`, 0 and
    empty lists, as does a model without languages.
    """
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.asarray(langs, object)
        for whole in batches:
            for batch in slices(whole, "letters"):
                rows = len(batch)
                share = proportions(*_grams(batch.column("letters")), rows, logp) if len(langs) else np.zeros((rows, 1))
                top = share.argmax(axis=1)
                score = share[np.arange(rows), top]
                order = np.argsort(-share, axis=1, kind="stable")
                kept = [[j for j in row if share[i, j] > 0] for i, row in enumerate(order)]
                pred = [str(names[t]) if s > 0 else "und" for t, s in zip(top, score, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)),
                     pa.array([[str(names[j]) for j in k] for k in kept], pa.list_(pa.string())),
                     pa.array([[float(share[i, j]) for j in k] for i, k in enumerate(kept)], pa.list_(pa.float64()))],
                    [*keep, "lang_pred", "score", "langs", "shares"])

    source = docs.select(*keep, letters(F.col("text")).alias("letters"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields)
    return source.mapInArrow(predict, f"{fields}, lang_pred string, score double, langs array<string>, shares array<double>")
