"""Linear models as tables: storing, scoring inside the row, and checks that use joins only.

A stored model is two Parquet tables. `weights` has (part, term, idf, label, weight), `intercepts`
has (label, position, intercept). Scoring reads them as a lookup when they are small enough, so a
text meets the model inside its own row and nothing is shuffled; a larger model is joined by term.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chirrup import params as P
from chirrup.operators import linear as L, topics as TP
from chirrup.session import written

LOOKUP_ROWS = 5_000_000  # rows of a weight table that are held as a lookup in every task
PRED = "predicted_label"


# ---- tables -------------------------------------------------------------------------------------

def weight_table(spark: SparkSession, model: L.LinearModel) -> DataFrame:
    """(part, term, position, idf, label, weight); as many rows as terms times classes."""
    v, k = model.vocabulary, len(model.classes)
    part = np.concatenate([np.repeat(n, len(t)) for (n, _), t in zip(v.parts, v.terms)]) if v.size else np.zeros(0, str)
    term = [t for ts in v.terms for t in ts.to_pylist()]
    position = np.concatenate([np.arange(len(t)) for t in v.terms]).astype(np.int32)
    rows = pa.table({
        "part": pa.array(np.repeat(part, k).tolist(), pa.string()), "term": pa.array(term, pa.string()).take(pa.array(np.repeat(np.arange(v.size), k))),
        "position": pa.array(np.repeat(position, k), pa.int32()), "idf": pa.array(np.repeat(np.concatenate(v.idf), k), pa.float64()),
        "label": pa.array(list(model.classes) * v.size, pa.string()), "weight": pa.array(model.weights.ravel(), pa.float64())})
    return spark.createDataFrame(rows)


def save_linear(spark: SparkSession, model: L.LinearModel, path: str) -> None:
    """Both tables and the settings beside them, on any Spark file system; an older model there is replaced."""
    weight_table(spark, model).write.mode("overwrite").parquet(f"{path}/weights")
    rows = [(c, i, float(b)) for i, (c, b) in enumerate(zip(model.classes, model.intercepts))]
    spark.createDataFrame(rows, "label string, position int, intercept double").coalesce(1).write.mode("overwrite").parquet(f"{path}/intercepts")
    parts = [{"name": n, "analyzer": p.analyzer, "ngrams": p.ngrams, "min_df": p.min_df, "max_terms": p.max_terms, "sublinear": p.sublinear} for n, p in model.spec.vectorizers]
    config = {"run_id": model.spec.run_id, "algorithm": model.spec.algorithm, "c": model.spec.c, "balanced": model.spec.balanced, "vectorizers": parts}
    spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1).write.mode("overwrite").text(f"{path}/config")


def load_linear(spark: SparkSession, path: str) -> L.LinearModel:
    """The stored model as a lookup; refuses a weight table above LOOKUP_ROWS (use `scored_by_join`)."""
    config = json.loads(spark.read.text(f"{path}/config").head()[0])
    vectorizers = tuple((p.pop("name"), P.TfidfParams(**{**p, "ngrams": tuple(p["ngrams"])})) for p in config.pop("vectorizers"))
    spec = L.ModelSpec(vectorizers=vectorizers, **config)
    ends = spark.read.parquet(f"{path}/intercepts").orderBy("position").collect()
    classes = tuple(r.label for r in ends)
    stored = spark.read.parquet(f"{path}/weights")
    n = stored.count()
    if n > LOOKUP_ROWS:
        raise ValueError(f"{n} weights do not fit a lookup of {LOOKUP_ROWS}")
    rows = stored.toPandas()
    terms, idf, weights = [], [], []
    for name, _ in vectorizers:
        mine = rows[rows["part"] == name]
        terms.append(pa.array(mine[mine["label"] == classes[0]].sort_values("position")["term"], pa.string()))
        idf.append(mine[mine["label"] == classes[0]].sort_values("position")["idf"].to_numpy(float))
        weights.append(mine.pivot(index="position", columns="label", values="weight")[list(classes)].to_numpy(float).reshape(-1, len(classes)))
    return L.LinearModel(spec, classes, L.Vocabulary(vectorizers, tuple(terms), tuple(idf)), np.concatenate(weights), np.array([r.intercept for r in ends]))


# ---- labels -------------------------------------------------------------------------------------

def predicted(df: DataFrame, models: Sequence[L.LinearModel], keep: Sequence[str], text: str = "text_clean") -> DataFrame:
    """`keep` with an array `labels`, one per model, from one pass over the texts (null text: no terms).

    The models share the vocabulary lookup of the first model that has a
    vectoriser; each text meets all weights inside its row.
    """
    parts: dict[str, tuple] = {}
    for m in models:
        for (n, p), t, i in zip(m.vocabulary.parts, m.vocabulary.terms, m.vocabulary.idf):
            if n in parts and not parts[n][1].equals(t):
                raise ValueError(f"models were fitted on different vocabularies of {n}")
            parts.setdefault(n, (p, t, i))
    joint = L.Vocabulary(tuple((n, p) for n, (p, _, _) in parts.items()), tuple(t for _, t, _ in parts.values()), tuple(i for _, _, i in parts.values()))
    stacked = np.zeros((joint.size + 1, sum(len(m.classes) for m in models)))
    at = 0
    for m in models:
        k = len(m.classes)
        rows = np.concatenate([joint.columns([n]) for n, _ in m.vocabulary.parts])
        stacked[rows, at : at + k], stacked[-1, at : at + k] = m.weights, m.intercepts
        at += k
    classes = [m.classes for m in models]
    held = df.sparkSession.sparkContext.broadcast((joint, stacked))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.select(*keep).dtypes), "labels array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = held.value
        for part, pointer, col, val in L._sparse(batches, vocabulary):
            z = L._margins(pointer, col, val, w)
            labels, at = [], 0
            for names in classes:
                labels.append(np.array(names, object)[z[:, at : at + len(names)].argmax(axis=1)])
                at += len(names)
            lists = pa.array(list(map(list, zip(*labels))), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "labels"])

    units = L._units(df.select(*dict.fromkeys([*keep, text])), text, joint.parts)
    return units.select(*keep, *[f"_u_{n}" for n, _ in joint.parts]).mapInArrow(run, schema)


def margins_by_join(df: DataFrame, model: L.LinearModel, key: str = "text_id", text: str = "text_clean") -> DataFrame:
    """(key, label, margin) from joins and sums only: the same model without a lookup, for any size of vocabulary."""
    k, spark = len(model.classes), df.sparkSession
    weights = _by_term(spark, model)
    small = model.vocabulary.size * k <= LOOKUP_ROWS
    # texts of one key meet before they are cut into terms, so no row of a term is shuffled for its text
    texts = df.select(key, text).repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)
    sums = None
    for name, p in model.vocabulary.parts:
        tf = TP.term_frequencies(texts, key, text, p)
        terms = weights.where(F.col("part") == name).drop("part")
        raw = tf.join(F.broadcast(terms) if small else terms, "term").withColumn("w", TP.tf_weight(F.col("tf"), p.sublinear) * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")))
        part = raw.groupBy(key).agg(*[(F.sum(F.col("w") * F.col(f"w{j}")) / norm).alias(f"s{j}") for j in range(k)])
        sums = part if sums is None else sums.unionByName(part)
    sums = sums.groupBy(key).agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)])
    ends = [F.struct(F.lit(c).alias("label"), (F.lit(float(b)) + F.coalesce(f"s{j}", F.lit(0.0))).alias("margin")) for j, (c, b) in enumerate(zip(model.classes, model.intercepts))]
    return df.select(key).join(sums, key, "left").select(key, F.inline(F.array(*ends)))


def labels_by_join(df: DataFrame, model: L.LinearModel, key: str = "text_id", text: str = "text_clean") -> DataFrame:
    """Best label per text by `margins_by_join`; ties by class order."""
    position = F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("label"))
    best = F.min_by("label", F.struct((-F.col("margin")).alias("m"), position.alias("p")))
    return margins_by_join(df, model, key, text).groupBy(key).agg(best.alias(PRED))


# ---- optimality ---------------------------------------------------------------------------------

def optimality(train: DataFrame, models: Sequence[L.LinearModel], label: str, key: str = "text_id", text: str = "text_clean") -> DataFrame:
    """(run_id, gradient, optimal): the largest gradient entry of each model's objective over all of `train`.

    Written as joins and aggregates, apart from the solver: residuals per text
    and class from the margins, their weighted sums per feature, the penalty's
    share, and the maximum over features and intercepts. Models over one
    vocabulary are columns of the same two joins. The intercept is feature -1,
    which every text has with the value 1. Only texts and margins are stored or
    shuffled as rows: the features of a text are made anew for each of the two
    joins, and their sums leave two tasks a core.
    """
    spark, out, groups = train.sparkSession, None, {}
    for m in models:
        groups.setdefault((m.classes, *(id(t) for t in m.vocabulary.terms)), []).append(m)
    for some in groups.values():
        classes, vocabulary = some[0].classes, some[0].vocabulary
        width = len(some) * len(classes)
        rows = train.where(F.col(label).isin(*classes)).select(text, F.col(label).alias("truth"), F.monotonically_increasing_id().alias("row"))
        rows = written(rows, "numbered-texts")
        counts = rows.groupBy("truth").agg(F.count(F.lit(1)).alias("n")).collect()
        total = max(sum(r.n for r in counts), 1)
        weights = _by_column(spark, some)
        small = vocabulary.size * width <= LOOKUP_ROWS
        margins = (_entries(rows, vocabulary, ["row"], text).join(F.broadcast(weights) if small else weights, "col")
                   .groupBy("row").agg(*[F.sum(F.col("value") * F.col(f"w{j}")).alias(f"z{j}") for j in range(width)]))
        margins = written(margins, "margins")
        scored = rows.join(F.broadcast(margins) if total * width <= LOOKUP_ROWS else margins, "row")
        slopes = []
        for i, m in enumerate(some):
            share = F.lit(1.0 / total)
            if m.spec.balanced:
                share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r.truth, 1.0 / (len(counts) * r.n))]), F.col("truth")) if counts else share
            z = [F.col(f"z{i * len(classes) + k}") for k in range(len(classes))]
            slopes += [(s * share).alias(f"r{i * len(classes) + k}") for k, s in enumerate(_slopes(m.spec.algorithm, classes, z))]
        data = (_entries(scored.select(text, *slopes).coalesce(2 * spark.sparkContext.defaultParallelism), vocabulary, [f"r{j}" for j in range(width)], text)
                .groupBy("col").agg(*[F.sum(F.col("value") * F.col(f"r{j}")).alias(f"g{j}") for j in range(width)]))
        most = []
        for i, m in enumerate(some):
            held = F.when((F.col("col") >= 0) | F.lit(m.spec.algorithm == "svm"), 1.0 / (m.spec.c * total)).otherwise(0.0)
            at = range(i * len(classes), (i + 1) * len(classes))
            most.append(F.array_max(F.array(*[F.max(F.abs(F.coalesce(f"g{j}", F.lit(0.0)) + held * F.col(f"w{j}"))) for j in at])))
        found = weights.join(data, "col", "left").agg(F.array(*[
            F.struct(F.lit(m.spec.run_id).alias("run_id"), g.alias("gradient"), (g <= 1.01 * m.spec.tolerance).alias("optimal")) for m, g in zip(some, most)]).alias("runs"))
        row = found.select(F.inline("runs"))
        out = row if out is None else out.unionByName(row)
    return out


def _entries(rows: DataFrame, vocabulary: L.Vocabulary, keep: Sequence[str], text: str) -> DataFrame:
    """`keep` with one row for each feature of a text and for the intercept."""
    features = L.feature_rows(rows, vocabulary, keep, text)
    return features.select(*keep, F.inline(F.concat("features", F.array(F.struct(F.lit(-1).alias("col"), F.lit(1.0).alias("value"))))))


def _by_term(spark: SparkSession, model: L.LinearModel) -> DataFrame:
    """One row per part and term with its idf and the weights w0, w1, ... of all classes."""
    v = model.vocabulary
    part = np.concatenate([np.repeat(n, len(t)) for (n, _), t in zip(v.parts, v.terms)]) if v.size else np.zeros(0, str)
    columns = {f"w{j}": pa.array(np.ascontiguousarray(x)) for j, x in enumerate(model.weights.T)}
    terms = pa.concat_arrays([t.cast(pa.string()) for t in v.terms])
    return spark.createDataFrame(pa.table({"part": pa.array(part.tolist(), pa.string()), "term": terms, "idf": pa.array(np.concatenate(v.idf), pa.float64()), **columns}))


def _by_column(spark: SparkSession, models: Sequence[L.LinearModel]) -> DataFrame:
    """One row per feature with the weights w0, w1, ... of all classes of all models; row -1 holds the intercepts."""
    w = np.concatenate([np.vstack((m.intercepts[None], m.weights)) for m in models], axis=1)
    columns = {f"w{j}": pa.array(np.ascontiguousarray(x)) for j, x in enumerate(w.T)}
    return spark.createDataFrame(pa.table({"col": pa.array(np.arange(-1, len(w) - 1).astype(np.int32)), **columns}))


def _slopes(algorithm: str, classes: Sequence[str], z: Sequence[Column]) -> list[Column]:
    """Derivatives of a text's loss by the margins of the classes."""
    hits = [F.col("truth") == c for c in classes]
    if algorithm == "svm":
        sides = [F.when(h, 1.0).otherwise(-1.0) for h in hits]
        return [-2 * s * F.greatest(1 - s * x, F.lit(0.0)) for s, x in zip(sides, z)]
    if algorithm != "lr":
        raise ValueError(f"{algorithm} has no gradient")
    top = F.array_max(F.array(*z))
    e = [F.exp(x - top) for x in z]
    total = sum(e[1:], e[0])
    return [x / total - h.cast("double") for x, h in zip(e, hits)]
