"""Linear text classifiers fitted together: one pass over the feature table serves every model.

Features are rows of term counts packed into blocks of a few bytes an entry (gaps between columns,
counts, one norm a text and vectoriser), written once and read by every pass; idf weights lie in the
coefficients. A solver pass moves bytes and no objects. All models of a call (regularisation strengths, class weights, losses, vectorisers) put
their trial coefficients side by side; a pass returns each model's loss and gradient, and models
that have reached their optimum leave the next pass. Every solver is a generator that asks for one
evaluation at a time, so a pass answers all of them at once.

What the driver holds is bounded by vocabulary size (`max_terms` of each vectoriser) times the
columns of the models. Partial sums are added on the cluster, so a pass sends it one gradient.

Losses: "lr" is the multinomial log loss; "svm" the squared hinge, one class against the rest; "nb"
is multinomial naive Bayes in closed form. Penalties are |W|^2 / (2 C n) on the mean loss; the
intercept is free for "lr" and penalised for "svm". A model is optimal when no entry of the gradient
exceeds `tolerance`; a solver that meets its limit first fails.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chirrup import params as P
from chirrup.functions import text as X
from chirrup.operators import topics as TP
from chirrup.session import fresh_dir, settings, written

BLOCK_ENTRIES = 1 << 16  # entries of one block of features: the arrays of one stay in a core's cache
BLOCKS_AT_ONCE = 4  # blocks of an Arrow batch: a task works on one batch while the next is on its way
TEXTS_AT_ONCE = 512  # texts of an Arrow batch
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # the files of a finished pass go at once
FEW_PARTS = 1  # partial sums that go straight to the driver; more are added on the cluster
SLOT = 1 << 15  # numbers of a gradient that one task adds up
TOKENS_AT_ONCE = 1 << 15
TERMS_HELD = 1 << 18  # counted terms of several runs that a task adds up before it sends them
HISTORY_BYTES = 128 << 20  # steps that all solvers of a call may hold on the driver
FEW_STEPS, MOST_STEPS = 12, 40  # of one solver; more steps save passes
DIRECTIONS = 16  # of the strongest curvature that a solver takes in even steps; they halve the passes
WIDE = 255  # marks a number that does not fit its byte


@dataclass(frozen=True)
class ModelSpec:
    """One row of an experiment plan."""

    run_id: str
    vectorizers: tuple[tuple[str, P.TfidfParams], ...]
    algorithm: str  # "lr", "svm" or "nb"
    c: float = 1.0
    balanced: bool = False
    limit: int = 2000  # evaluations
    tolerance: float = 1e-4  # largest entry of the gradient of the mean objective

    @property
    def config(self) -> str:
        names = "+".join(f"{n}{p.ngrams}" for n, p in self.vectorizers)
        return f"{names} {self.algorithm} C={self.c}{' balanced' if self.balanced else ''}"


# ---- vocabulary and features --------------------------------------------------------------------

@dataclass(frozen=True, eq=False)
class Vocabulary:
    """Terms and idf weights of vectorisers side by side; each has a range of feature columns."""

    parts: tuple[tuple[str, P.TfidfParams], ...]
    terms: tuple[pa.Array, ...]
    idf: tuple[np.ndarray, ...]

    @property
    def starts(self) -> list[int]:
        return np.concatenate(([0], np.cumsum([len(t) for t in self.terms]))).astype(int).tolist()

    @property
    def size(self) -> int:
        return self.starts[-1]

    def columns(self, names: Sequence[str]) -> np.ndarray:
        """Feature columns of the named vectorisers, in the order of the names."""
        every, at = self.starts, {n: i for i, (n, _) in enumerate(self.parts)}
        return np.concatenate([np.arange(every[at[n]], every[at[n] + 1]) for n in names])

    def only(self, names: Sequence[str]) -> Vocabulary:
        at = {n: i for i, (n, _) in enumerate(self.parts)}
        keep = [at[n] for n in names]
        return Vocabulary(tuple(self.parts[i] for i in keep), tuple(self.terms[i] for i in keep), tuple(self.idf[i] for i in keep))


def fit_vocabulary(docs: DataFrame, parts: Sequence[tuple[str, P.TfidfParams]], key: str = "text_id", text: str = "text_clean") -> Vocabulary:
    """The `max_terms` most frequent terms of each vectoriser, ties by term, with smoothed idf."""
    n_docs = docs.count()
    counted = written(term_counts(docs, parts, key, text), "term-counts")
    found = [TP.most_frequent(counted.where(F.col("part") == n), p).select("term", "df").toArrow() for n, p in parts]
    idf = tuple(np.log((1 + n_docs) / (1 + t.column("df").to_numpy())) + 1 for t in found)
    return Vocabulary(tuple(parts), tuple(t.column("term").combine_chunks().cast(pa.string()) if len(t) else pa.array([], pa.string()) for t in found), idf)


def term_counts(docs: DataFrame, parts: Sequence[tuple[str, P.TfidfParams]], key: str, text: str) -> DataFrame:
    """(part, term, df, total) of all vectorisers from one pass over the texts.

    A task sends each term of about TERMS_HELD counted terms once, and there are two tasks a core,
    so what is shuffled grows with the distinct terms of these and not with the terms of every text. Texts that
    share a key are one document; they are counted by `term_frequencies`.
    """
    several = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("_several"))
    same, single = F.col(key).eqNullSafe(F.col("_several")), docs
    shared = None
    if not several.isEmpty():
        single, together = docs.join(several, same, "left_anti"), docs.join(several, same, "left_semi")
        for n, p in parts:
            counts = TP.document_frequency(TP.term_frequencies(together, key, text, p)).select(F.lit(n).alias("part"), "term", "df", "total")
            shared = counts if shared is None else shared.unionByName(counts)
    names = ["part", "term", "df", "total"]

    def added(runs: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        sums = pa.concat_tables(runs).group_by("term", use_threads=False).aggregate([("df", "sum"), ("total", "sum")])
        return iter(sums.rename_columns(["term", "df", "total"]).combine_chunks().to_batches())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {n: [] for n, _ in parts}

        def told(n: str) -> Iterator[pa.RecordBatch]:
            for b in added(held.pop(n)):
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(b), pa.string()), *b.columns], names)

        for batch in batches:
            for some in _slices(batch, [f"_u_{n}" for n, _ in parts]):
                for n, p in parts:
                    _, code, tf, terms = _counted(some.column(f"_u_{n}"), p)
                    df, total = np.bincount(code, minlength=len(terms)), np.bincount(code, tf, len(terms)).astype(np.int64)
                    held.setdefault(n, []).append(pa.table([terms, pa.array(df.astype(np.int64)), pa.array(total)], names[1:]))
                    if sum(map(len, held[n])) >= TERMS_HELD:
                        yield from told(n)
        for n in [n for n, runs in held.items() if runs]:
            yield from told(n)

    cores = docs.sparkSession.sparkContext.defaultParallelism
    units = _units(single.select(text), text, parts).select(*[f"_u_{n}" for n, _ in parts]).coalesce(2 * cores)
    counts = units.mapInArrow(run, "part string, term string, df long, total long")
    if shared is not None:
        counts = counts.unionByName(shared)
    return counts.groupBy("part", "term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _units(df: DataFrame, text: str, parts: Sequence[tuple[str, P.TfidfParams]]) -> DataFrame:
    """Per vectoriser an array `_u_<name>`: the words in which its terms lie."""
    for name, p in parts:
        words = X.words(F.lower(F.coalesce(F.col(text), F.lit("")))) if p.analyzer == "char" else X.word_tokens(text)
        df = df.withColumn(f"_u_{name}", words)
    return df


def word_grams(word: str, low: int, high: int) -> list[str]:
    """Character grams of a word padded with one blank each side; a shorter word is one gram."""
    padded = f" {word} "
    if len(padded) < low:
        return [padded]
    return [padded[i : i + n] for n in range(low, min(high, len(padded)) + 1) for i in range(len(padded) - n + 1)]


def _grams(words: pa.Array, low: int, high: int) -> tuple[pa.Array, np.ndarray]:
    """The `word_grams` of all words one after another, and how many each word has; cut from the bytes of the words."""
    padded = pc.binary_join_element_wise("", words, "", " ")
    offs = np.frombuffer(padded.buffers()[1], np.int32)[padded.offset : padded.offset + len(padded) + 1].astype(np.int64)
    data = np.frombuffer(padded.buffers()[2], np.uint8)[: offs[-1]] if len(words) else np.zeros(0, np.uint8)
    point = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # byte where each character begins
    begin = np.searchsorted(point, offs)
    length, begin = np.diff(begin), begin[:-1]
    counts = [np.maximum(length - n + 1, 0) for n in range(low, high + 1)]
    short = np.flatnonzero(length < low)
    size = sum(counts) + (length < low)
    before = np.cumsum(size) - size
    start, stop = np.empty(size.sum(), np.int64), np.empty(size.sum(), np.int64)
    start[before[short]], stop[before[short]] = point[begin[short]], point[begin[short] + length[short]]
    for n, count in zip(range(low, high + 1), counts):
        i = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at, slot = np.repeat(begin, count) + i, np.repeat(before, count) + i
        start[slot], stop[slot] = point[at], point[at + n]
        before = before + count
    ends = np.concatenate(([0], np.cumsum(stop - start)))
    taken = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], stop - start)]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(taken)), size


def _sums(row: np.ndarray, code: np.ndarray, kinds: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) in order, with the sums of their weights."""
    key = row * max(kinds, 1) + code
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    total = np.add.reduceat(weight[order], first) if len(first) else np.zeros(0, np.int64)
    return *np.divmod(key[first], max(kinds, 1)), total


def _counted(lists: pa.Array, params: P.TfidfParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, tf) of the distinct terms of each row, in row order, and the terms by code."""
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lists)), sizes)
    word, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.string())
    if params.analyzer == "char":
        # the grams of a word depend on the word alone: each distinct word is cut once
        row, word, n = _sums(row, word, len(words), np.ones(len(word), np.int64))
        grams, size = _grams(words, *params.ngrams)
        known = grams.dictionary_encode()
        terms = known.dictionary.cast(pa.string())
        first, times = np.cumsum(size) - size, size[word]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[word], times)
        code = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)[at]
        return *_sums(np.repeat(row, times), code, len(terms), np.repeat(n, times)), terms
    low, high = params.ngrams
    rows, codes, terms, kinds = [], [], [], 0
    at, code, names = np.arange(len(word)), word, words
    for n in range(1, high + 1):
        if n > 1:  # the runs of n - 1 words that have a next word in their row
            go = at + n - 1 < len(word)
            go[go] = row[at[go] + n - 1] == row[at[go]]
            at = at[go]
            pair, code = np.unique(code[go] * max(len(words), 1) + word[at + n - 1], return_inverse=True)
            head, tail = np.divmod(pair, max(len(words), 1))
            names = pc.binary_join_element_wise(names.take(pa.array(head)), words.take(pa.array(tail)), " ")
        if n >= low:
            rows.append(row[at])
            codes.append(code + kinds)
            terms.append(names)
            kinds += len(names)
    code = np.concatenate(codes)
    return *_sums(np.concatenate(rows), code, kinds, np.ones(len(code), np.int64)), pa.concat_arrays(terms)


def _part_rows(batch: pa.RecordBatch, vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, column, tf, weight, norm of each row) of each vectoriser, by row and column; a weight over its norm is the value."""
    for (name, p), terms, idf, start in zip(vocabulary.parts, vocabulary.terms, vocabulary.idf, vocabulary.starts):
        r, code, tf, found = _counted(batch.column(f"_u_{name}"), p)
        c = pc.index_in(found, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
        order = np.argsort((r * max(len(terms), 1) + c)[c >= 0])
        r, c, tf = (x[c >= 0][order] for x in (r, c, tf))
        w = (1 + np.log(tf) if p.sublinear else tf.astype(float)) * idf[c]
        yield r, c + start, tf, w, np.sqrt(np.bincount(r, w * w, len(batch)))


def _rows(batch: pa.RecordBatch, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pointer, column, value) of the unit-length TF-IDF rows of a batch, vectorisers side by side."""
    parts = [(r, c, w / norm[r]) for r, c, _, w, norm in _part_rows(batch, vocabulary)]
    row, col, val = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(row, kind="stable")
    pointer = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(batch)))))
    return pointer, col[order], val[order]


def _slices(batch: pa.RecordBatch, units: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Row runs of bounded numbers of units."""
    sizes = sum(np.asarray(batch.column(u).value_lengths().fill_null(0), np.int64) for u in units)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > TOKENS_AT_ONCE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if len(batch):
        yield batch.slice(start)


def _sparse(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[tuple]:
    for part in _runs(batches, vocabulary):
        yield part, *_rows(part, vocabulary)


def _runs(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _slices(batch, [f"_u_{n}" for n, _ in vocabulary.parts])


def feature_rows(df: DataFrame, vocabulary: Vocabulary, keep: Sequence[str], text: str = "text_clean") -> DataFrame:
    """`keep` with the features of each text as (column, value) entries."""
    held = df.sparkSession.sparkContext.broadcast(vocabulary)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.select(*keep).dtypes), "features array<struct<col: int, value: double>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pointer, col, val in _sparse(batches, held.value):
            entries = pa.StructArray.from_arrays([pa.array(col.astype(np.int32)), pa.array(val)], ["col", "value"])
            lists = pa.ListArray.from_arrays(pa.array(pointer.astype(np.int32)), entries)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "features"])

    units = _units(df.select(*keep, text) if text not in keep else df.select(*keep), text, vocabulary.parts)
    return units.select(*keep, *[f"_u_{n}" for n, _ in vocabulary.parts]).mapInArrow(run, schema)


_BLOCK = pa.schema([(n, pa.binary()) for n in ("y", "pointer", "col", "val")])


def _bytes(numbers: np.ndarray) -> bytes:
    """Whole numbers as one byte each; those outside of 0 to 254 follow as four bytes."""
    wide = (numbers < 0) | (numbers >= WIDE)
    return np.where(wide, WIDE, numbers).astype(np.uint8).tobytes() + numbers[wide].astype(np.int32).tobytes()


def _numbers(data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n bytes written by `_bytes`, the places of the wide numbers and these."""
    small = data[:n]
    return small, np.flatnonzero(small == WIDE), data[n:].view(np.int32)


def _packed(y: np.ndarray, parts: Sequence[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One block: labels, entries of each row, gaps between the columns, norms and term counts; vectoriser after vectoriser."""
    size, col, tf, norm = (np.concatenate(x) for x in zip(*parts))
    arrays = (y.astype(np.int32).tobytes(), size.astype(np.int32).tobytes(), _bytes(np.diff(col, prepend=0)), norm.tobytes() + _bytes(tf))
    return pa.RecordBatch.from_arrays([pa.array([a], pa.binary()) for a in arrays], schema=_BLOCK)


class _Room:
    """Arrays that are used again for every block: new ones cost more than what is done with them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def of(self, name: str, n: int, kind: type) -> np.ndarray:
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty(max(n, BLOCK_ENTRIES), kind)
        return self.held[name][:n]


def _unpacked(batch: pa.RecordBatch, i: int, room: _Room | None = None) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Labels of a block and, for each vectoriser, (entries of each row, column, tf as a byte, places of wide tf, wide tf, norm)."""
    y, size, gaps, val = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint8) for k in _BLOCK.names)
    y, size = y.view(np.int32), size.view(np.int32)
    n = int(size.sum())
    small, at, wide = _numbers(gaps, n)
    col = (room or _Room()).of("col", n, np.intp)
    np.copyto(col, small)
    col[at] = wide
    np.cumsum(col, out=col)
    norm = val[: 8 * len(size)].view(np.float64)
    tf, at, wide = _numbers(val[8 * len(size) :], n)
    out, end = [], 0
    for first in range(0, len(size), max(len(y), 1)):
        own = slice(first, first + len(y))
        start, end = end, end + int(size[own].sum())
        mine = slice(*np.searchsorted(at, (start, end)))
        out.append((size[own], col[start:end], tf[start:end], at[mine] - start, wide[mine], norm[own]))
    return y, out


def training_blocks(df: DataFrame, vocabulary: Vocabulary, label: str, classes: Sequence[str], text: str = "text_clean") -> DataFrame:
    """Feature blocks of the rows with a known label, written to the shared folder (`_packed`)."""
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)
    known = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    rows = _units(df.where(F.col(label).isin(*classes)).select(known.cast("int").alias("_y"), text), text, vocabulary.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _runs(batches, held.value):
            y = some.column("_y").to_numpy()
            parts = []
            for r, c, tf, _, norm in _part_rows(some, held.value):
                size = np.bincount(r, minlength=len(y))
                parts.append((size, np.concatenate(([0], np.cumsum(size))), c, tf, norm))
            pointer = sum(p[1] for p in parts)
            at = 0
            while at < len(y):
                end = max(int(np.searchsorted(pointer, pointer[at] + BLOCK_ENTRIES, "right")) - 1, at + 1)
                yield _packed(y[at:end], [(size[at:end], c[p[at] : p[end]], tf[p[at] : p[end]], norm[at:end]) for size, p, c, tf, norm in parts])
                at = end

    path = fresh_dir(spark, "feature-blocks")
    units = rows.select("_y", *[f"_u_{n}" for n, _ in vocabulary.parts])
    units.mapInArrow(run, ", ".join(f"{n} binary" for n in _BLOCK.names)).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# ---- one pass for all models --------------------------------------------------------------------

@dataclass(frozen=True)
class Problem:
    """One convex problem: `width` columns of coefficients over the feature columns `used` and the intercept."""

    run_id: str
    kind: str
    target: int  # class against the rest, or -1 for all classes
    width: int
    used: np.ndarray
    class_weight: np.ndarray
    total: float  # sum of row weights
    c: float

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.used) + 1, self.width

    @property
    def margins(self) -> int:
        """Margins that a pass computes: the log loss depends on their differences from the last class only."""
        return self.width - 1 if self.kind == "lr" else self.width

    def penalised(self, loss: float, grad: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss and gradient with the penalty; the intercept (last row) is free for the log loss."""
        strength = 1.0 / (self.c * self.total)
        held = x.copy()
        if self.kind == "lr":
            held[-1] = 0.0
        return loss / self.total + 0.5 * strength * float((held * held).sum()), grad / self.total + strength * held


def _losses(problem: Problem, z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss of the margins of a problem, and its derivative by the margins."""
    if problem.kind == "gram":
        return 0.0, z
    weight = problem.class_weight[y]
    if problem.kind == "svm":
        side = np.where(y == problem.target, 1.0, -1.0)[:, None]
        gap = np.maximum(1 - side * z, 0.0)
        return float((weight[:, None] * gap * gap).sum()), -2.0 * weight[:, None] * side * gap
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=1, keepdims=True)
    rows = np.arange(len(y))
    loss = weight * (np.log(total[:, 0]) + top[:, 0] - z[rows, y])
    slope = e / total
    slope[rows, y] -= 1.0
    return float(loss.sum()), weight[:, None] * slope


def _margins(pointer: np.ndarray, col: np.ndarray, val: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows times coefficients plus the intercept (last row of `w`), one contiguous column at a time."""
    z = np.zeros((len(pointer) - 1, w.shape[1]))
    some = np.flatnonzero(np.diff(pointer))
    if len(some):
        start = pointer[some]
        for k, x in enumerate(np.ascontiguousarray(w.T)):
            products = x.take(col)
            products *= val
            z[some, k] = np.add.reduceat(products, start)
    return z + w[-1]


def _pass(held) -> Callable:
    """Sums one task's loss and gradient for every problem; a gradient holds the problem's own columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, problems, uses, idf, sublinear = held.value
        counts = np.arange(WIDE + 1, dtype=float)
        damped = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
        grad, loss, room = np.zeros(w.shape), np.zeros(len(problems)), _Room()
        for batch in batches:
            for i in range(len(batch)):
                y, parts = _unpacked(batch, i, room)
                z, held_parts = np.repeat(w[:, -1:], len(y), axis=1), []
                for j, (times, col, tf, at, wide, norm) in enumerate(parts):
                    columns = uses[j] if uses else range(len(w))
                    some = np.flatnonzero(times)
                    if not len(some) or not len(columns):
                        continue
                    even = sublinear[j] if uses else True
                    val, row, products = (room.of(f"{name}{j}", len(col), kind) for name, kind in (("val", float), ("row", np.intp), ("products", float)))
                    (damped if even else counts).take(tf, out=val, mode="clip")
                    val[at] = 1 + np.log(wide) if even else wide
                    start, scale = (np.cumsum(times) - times)[some], 1.0 / norm[some]
                    row.fill(0)
                    row[start[1:]] = 1
                    np.cumsum(row, out=row)
                    for k in columns:
                        w[k].take(col, out=products, mode="clip")
                        np.multiply(products, val, out=products)
                        z[k, some] += np.add.reduceat(products, start) * scale
                    held_parts.append((columns, some, scale, col, val, row, products))
                slopes, at = np.empty(z.shape), 0
                for k, p in enumerate(problems):
                    own = z[at : at + p.margins].T
                    part, slope = _losses(p, np.hstack((own, np.zeros((len(y), 1)))) if p.kind == "lr" else own, y)
                    loss[k] += part
                    slopes[at : at + p.margins] = slope.T[: p.margins]
                    at += p.margins
                grad[:, -1] += slopes.sum(axis=1)
                for columns, some, scale, col, val, row, products in held_parts:
                    for k in columns:
                        (slopes[k, some] * scale).take(row, out=products, mode="clip")
                        np.multiply(products, val, out=products)
                        np.add.at(grad[k], col, products)
        grad *= idf
        at, flat = 0, [loss]
        for p in problems:
            own = grad[at : at + p.margins, np.append(p.used, len(idf) - 1)].T
            flat.append((np.hstack((own, -own.sum(axis=1, keepdims=True))) if p.kind == "lr" else own).ravel())
            at += p.margins
        flat = np.concatenate(flat)
        slots = range(0, len(flat), SLOT)
        yield pa.RecordBatch.from_arrays([pa.array([s // SLOT for s in slots], pa.int32()), pa.array([flat[s : s + SLOT].tobytes() for s in slots], pa.binary())], ["slot", "part"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, part in zip(batch.column("slot").to_pylist(), batch.column("part")):
            values = np.frombuffer(part.as_buffer(), np.float64)
            sums[slot] = sums[slot] + values if slot in sums else values
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["slot", "part"])


def evaluate(
    blocks: DataFrame, problems: Sequence[Problem], trials: Sequence[np.ndarray], size: int, parts: int, vocabulary: Vocabulary | None = None,
) -> list[tuple[float, np.ndarray]]:
    """Loss and gradient of every problem at its trial coefficients, from one pass over the blocks.

    Without the vocabulary every idf is 1 and every count damped.
    """
    idf = np.append(np.concatenate(vocabulary.idf), 1.0) if vocabulary else np.ones(size + 1)
    w, owner = np.zeros((sum(p.margins for p in problems), size + 1)), []
    for p, x in zip(problems, trials):
        columns = (x[:, :-1] - x[:, -1:] if p.kind == "lr" else x).T
        w[len(owner) : len(owner) + p.margins, np.append(p.used, size)] = columns
        owner += [p] * p.margins
    w *= idf
    uses, sublinear = None, None
    if vocabulary:
        uses = [[k for k, p in enumerate(owner) if low in p.used] if low < high else [] for low, high in zip(vocabulary.starts, vocabulary.starts[1:])]
        sublinear = [p.sublinear for _, p in vocabulary.parts]
    held = blocks.sparkSession.sparkContext.broadcast((w, list(problems), uses, idf, sublinear))
    schema = "slot int, part binary"
    total = np.zeros(len(problems) + sum(x.size for x in trials))
    sums = blocks.mapInArrow(_pass(held), schema)
    if parts > FEW_PARTS:
        sums = sums.repartition(min(parts, -(-len(total) // SLOT)), "slot").mapInArrow(_added, schema)
    rows = sums.toArrow()
    for slot, part in zip(rows.column("slot").to_pylist(), rows.column("part")):
        values = np.frombuffer(part.as_buffer(), np.float64)
        total[slot * SLOT : slot * SLOT + len(values)] += values
    held.destroy()
    at, out = len(problems), []
    for k, (p, x) in enumerate(zip(problems, trials)):
        out.append(p.penalised(total[k], total[at : at + x.size].reshape(x.shape), x))
        at += x.size
    return out


def strongest(blocks: DataFrame, sets: Sequence[np.ndarray], n_rows: float, size: int, parts: int, vocabulary: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each set of feature columns, and the intercept, directions and sizes of the largest parts of X'X / n.

    A randomised Nystrom approximation from one pass; all rows count alike.
    """
    tried = [np.linalg.qr(np.random.default_rng(0).normal(size=(len(used) + 1, min(DIRECTIONS, len(used) + 1))))[0] for used in sets]
    gram = [Problem("", "gram", -1, t.shape[1], used, np.ones(1), 1.0, np.inf) for used, t in zip(sets, tried)]
    out = []
    for t, (_, product) in zip(tried, evaluate(blocks, gram, tried, size, parts, vocabulary)):
        inner = t.T @ product
        value, vector = np.linalg.eigh((inner + inner.T) / 2)
        some = value > 1e-10 * max(value.max(initial=0.0), 1e-300)
        directions, root, _ = np.linalg.svd(product @ (vector[:, some] / np.sqrt(value[some])), full_matrices=False)
        out.append((directions, root * root / max(n_rows, 1.0)))
    return out


# ---- solver -------------------------------------------------------------------------------------

def even_steps(problem: Problem, directions: np.ndarray, sizes: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A symmetric map of coefficients that brings the curvature along the strongest directions down to that of the weakest of them.

    The rows of texts have most of their length in common, with each other and
    with the intercept; solvers lose most passes on these few directions.
    """
    if not len(sizes):
        return lambda x: x
    curve = (0.25 if problem.kind == "lr" else 1.0) * sizes + 1.0 / (problem.c * problem.total)
    change = (np.sqrt(curve.min() / curve) - 1)[:, None]
    return lambda x: x + directions @ (change * (directions.T @ x))


def steps_held(problems: Sequence[Problem]) -> int:
    """Steps that each solver remembers: two arrays of its coefficients a step, HISTORY_BYTES for all, FEW_STEPS at least."""
    step = 16 * sum(p.shape[0] * p.shape[1] for p in problems)
    return max(FEW_STEPS, min(MOST_STEPS, HISTORY_BYTES // max(step, 1)))


def lbfgs(
    x: np.ndarray, tolerance: float, limit: int, scale: Callable[[np.ndarray], np.ndarray] | float = 1.0, memory: int = FEW_STEPS,
) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimise a smooth convex function; yields points and is sent (value, gradient).

    Two-loop recursion with a bracketing line search on the weak Wolfe
    conditions, in coordinates stretched by `scale`, a number or a symmetric
    map. Returns the first point where no entry of the gradient exceeds
    `tolerance`; raises after `limit` evaluations.
    """
    stretch, plain = scale if callable(scale) else lambda a: a * scale, np.zeros(0)
    inner = _scaled_lbfgs(np.zeros(x.shape), lambda _: np.abs(plain).max(initial=0.0) <= tolerance, limit, memory)
    step = next(inner)
    while True:
        value, plain = yield x + stretch(step)
        try:
            step = inner.send((value, stretch(plain)))
        except StopIteration as end:
            return x + stretch(end.value)


def _scaled_lbfgs(x: np.ndarray, good: Callable[[np.ndarray], bool], limit: int, memory: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    value, grad = yield x
    used, steps = 1, []
    while not good(grad):
        d, kept = -grad.ravel(), []
        for s, y in reversed(steps):
            a = (s @ d) / (s @ y)
            kept.append(a)
            d = d - a * y
        if steps:
            s, y = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(steps, reversed(kept)):
            d = d + s * (a - (y @ d) / (s @ y))
        d = d.reshape(x.shape)
        slope = float((grad * d).sum())
        if slope >= 0:
            steps, d = [], -grad
            slope = -float((grad * grad).sum())
        t, low, high = (1.0 if steps else min(1.0, 1.0 / np.abs(grad).sum())), 0.0, np.inf
        while True:
            if used >= limit:
                raise RuntimeError(f"no optimum after {used} evaluations")
            trial = x + t * d
            new_value, new_grad = yield trial
            used += 1
            if good(new_grad):
                return trial
            if new_value > value + 1e-4 * t * slope + 1e-13 * abs(value):
                high = t
            elif float((new_grad * d).sum()) < 0.9 * slope:
                low = t
            else:
                break
            t = 2 * t if high == np.inf else (low + high) / 2
            if high - low < 1e-14 * max(low, 1e-300):
                break
        s, y = (trial - x).ravel(), (new_grad - grad).ravel()
        if s @ y > 0:
            steps = [*steps, (s, y)][-memory:]
        x, value, grad = trial, new_value, new_grad
    return x


@dataclass(frozen=True, eq=False)
class LinearModel:
    """Coefficients (terms by classes) and intercepts over a vocabulary; the largest margin wins, ties by class order."""

    spec: ModelSpec
    classes: tuple[str, ...]
    vocabulary: Vocabulary
    weights: np.ndarray
    intercepts: np.ndarray


def fit_models(
    train: DataFrame, specs: Sequence[ModelSpec], label: str, classes: Sequence[str], key: str = "text_id", text: str = "text_clean",
) -> dict[str, LinearModel]:
    """Fit every spec on `train` (key, text, label) in shared passes; null and unknown labels are left out.

    The vocabulary of all vectorisers is built once and the features are written
    once. A class without rows is kept and never wins against one with rows
    under the log loss. Without any labelled row every coefficient is 0.
    """
    parts = tuple({n: (n, p) for s in specs for n, p in s.vectorizers}.values())
    rows, spark = train.where(F.col(label).isin(*classes)), train.sparkSession
    with settings(spark, {BATCH_ROWS: TEXTS_AT_ONCE, DROP_SHUFFLES: True}):
        vocabulary = fit_vocabulary(rows, parts, key, text)
        blocks = training_blocks(rows, vocabulary, label, classes, text)
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count(F.lit(1))).collect()}
    count = np.array([counts.get(c, 0) for c in classes], float)
    parts_wanted = max(1, min(spark.sparkContext.defaultParallelism, blocks.count()))
    with settings(spark, {BATCH_ROWS: BLOCKS_AT_ONCE, DROP_SHUFFLES: True}):
        return _fitted(blocks.coalesce(parts_wanted), specs, vocabulary, count, tuple(classes), parts_wanted)


def problems_of(spec: ModelSpec, vocabulary: Vocabulary, count: np.ndarray) -> list[Problem]:
    """The convex problems of a spec, given the rows of each class."""
    used = vocabulary.columns([n for n, _ in spec.vectorizers])
    present = count > 0
    even = np.divide(count.sum(), present.sum() * count, out=np.zeros_like(count), where=present)
    weight = even if spec.balanced else np.ones(len(count))
    total = max(float((weight * count).sum()), 1.0)
    targets = range(len(count)) if spec.algorithm == "svm" else [-1]
    return [Problem(spec.run_id, spec.algorithm, t, 1 if t >= 0 else len(count), used, weight, total, spec.c) for t in targets]


def _fitted(blocks: DataFrame, specs: Sequence[ModelSpec], vocabulary: Vocabulary, count: np.ndarray, classes: tuple[str, ...], parts: int) -> dict[str, LinearModel]:
    solvers, done = {}, {}
    convex = [spec for spec in specs if spec.algorithm != "nb"]
    problems = [(spec, p) for spec in convex for p in problems_of(spec, vocabulary, count)]
    memory = steps_held([p for _, p in problems])
    sets = {spec.vectorizers: p.used for spec, p in problems}
    found = dict(zip(sets, strongest(blocks, list(sets.values()), count.sum(), vocabulary.size, parts, vocabulary))) if sets else {}
    for spec, p in problems:
        scale = even_steps(p, *found[spec.vectorizers])
        solvers[spec.run_id, p.target] = (p, lbfgs(np.zeros(p.shape), spec.tolerance, spec.limit, scale, memory))
    asked = {k: next(s) for k, (_, s) in solvers.items()}
    while asked:
        keys = list(asked)
        answers = evaluate(blocks, [solvers[k][0] for k in keys], [asked[k] for k in keys], vocabulary.size, parts, vocabulary)
        for k, answer in zip(keys, answers):
            try:
                asked[k] = solvers[k][1].send(answer)
            except StopIteration as end:
                done[k] = end.value
                del asked[k]
    out = {}
    for spec in specs:
        names = [n for n, _ in spec.vectorizers]
        if spec.algorithm == "nb":
            weights, intercepts = _naive_bayes(blocks, vocabulary, vocabulary.columns(names), count, spec, parts)
        else:
            x = np.concatenate([done[k] for k in solvers if k[0] == spec.run_id], axis=1)
            weights, intercepts = x[:-1], x[-1]
        out[spec.run_id] = LinearModel(spec, classes, vocabulary.only(names), weights, intercepts)
    return out


def _naive_bayes(blocks: DataFrame, vocabulary: Vocabulary, used: np.ndarray, count: np.ndarray, spec: ModelSpec, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log probabilities; class sums of the features are the slope of the log loss at equal margins.

    At zero coefficients the slope of row i is 1/k - [class of i], so the class
    sums follow from one pass with one problem.
    """
    k = len(count)
    plain = Problem(spec.run_id, "lr", -1, k, used, np.ones(k), 1.0, np.inf)
    one = [Problem(spec.run_id, "lr", -1, k, used, np.eye(k)[c], 1.0, np.inf) for c in range(k)]
    zero = np.zeros(plain.shape)
    sums = np.zeros((len(used), k))
    for c, (_, grad) in enumerate(evaluate(blocks, one, [zero] * k, vocabulary.size, parts, vocabulary)):
        sums[:, c] = -grad[:-1, c] / (1 - 1 / k) if k > 1 else 0.0
    sums = np.maximum(sums, 0.0)
    log = np.log(sums + 1.0) - np.log(sums.sum(axis=0) + len(used))
    return log, np.log((count + 1.0) / (count.sum() + k))
