"""Experiment plans over linear text classifiers: sweeps, selection, scoring, inspection.

Fitting is `linear.fit_models`, which serves all models of a plan in shared
passes; scoring is `scoring.predicted`, one pass over the texts for all models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chirrup import params as P
from chirrup.functions import text as X
from chirrup.operators import evaluation as EV, scoring as SC, topics as TP
from chirrup.operators.linear import LinearModel, ModelSpec, fit_models
from chirrup.operators.ranking import top_per_group
from chirrup.operators.splits import stratified_split
from chirrup.session import cut_lineage

LABEL, PRED = "sentiment_label", "predicted_label"

# Fixed settings of the experiment plans.
WORD, CHAR = ("word", P.WORD_TFIDF), ("char", P.CHAR_TFIDF)
INCUMBENT = ModelSpec("incumbent", (CHAR,), "lr")
EXPERIMENTS = (
    ModelSpec("Exp-A", (CHAR,), "lr", c=0.5),
    ModelSpec("Exp-B", (CHAR,), "lr", c=5.0),
    ModelSpec("Exp-C", (CHAR, WORD), "lr"),
    ModelSpec("Exp-D", (CHAR,), "svm"),
    ModelSpec("Exp-E", (CHAR,), "lr", balanced=True),
)
BASELINES = (
    ModelSpec("word+nb", (WORD,), "nb"),
    ModelSpec("word+lr", (WORD,), "lr"),
    ModelSpec("word+svm", (WORD,), "svm"),
    INCUMBENT,
)


def fit_model(train: DataFrame, spec: ModelSpec, label: str = LABEL, classes: Sequence[str] = P.SENTIMENTS) -> LinearModel:
    """Fit on (`text_id`, `text_clean`, label) rows; scoring needs text only."""
    return fit_models(train, [spec], label, classes)[spec.run_id]


def score(model: LinearModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    """Predictions beside the true label."""
    scored = SC.predicted(df, [model], ["text_id", "text_clean", label])
    return scored.select("text_id", "text_clean", F.col(label).alias(EV.TRUE), F.get("labels", F.lit(0)).alias(PRED))


def batch_scoring(model: LinearModel, raw: DataFrame, text: str = "post_text", key: str = "text_id") -> DataFrame:
    """Raw text in, cleaned text and label out; no confidence is produced."""
    cleaned = raw.select(F.col(key), F.col(text).alias("raw_text"), X.clean_text(F.coalesce(F.col(text), F.lit(""))).alias("text_clean"))
    scored = SC.predicted(cleaned, [model], [key, "raw_text", "text_clean"])
    return scored.select(key, "raw_text", "text_clean", F.get("labels", F.lit(0)).alias("label"))


def batch_labels(model: LinearModel, raw: DataFrame, text: str = "post_text", key: str = "text_id") -> DataFrame:
    cleaned = raw.select(F.col(key), X.clean_text(F.coalesce(F.col(text), F.lit(""))).alias("text_clean"))
    return SC.predicted(cleaned, [model], [key]).select(key, F.get("labels", F.lit(0)).alias("label"))


# ------------------------------------------------------------- experiments
def run_log(scored: DataFrame, specs: Sequence[ModelSpec], classes: Sequence[str] = P.SENTIMENTS) -> DataFrame:
    """Overall metrics and per-class F1 of each run, from (run_id, truth, prediction) rows."""
    overall = EV.overall_metrics(scored, ["run_id"]).select("run_id", "accuracy", "macro_f1", "macro_precision", "macro_recall")
    f1 = EV.class_metrics(scored, ["run_id"]).groupBy("run_id").agg(
        *[F.coalesce(F.round(F.max(F.when(F.col("label") == c, F.col("f1"))), 4), F.lit(0.0)).alias(f"f1_{c.lower()}") for c in classes])
    names = scored.sparkSession.createDataFrame([(s.run_id, s.config) for s in specs], "run_id string, config string")
    return names.join(overall, "run_id").join(f1, "run_id")


def sweep(train: DataFrame, val: DataFrame, specs: Sequence[ModelSpec], label: str = LABEL, classes: Sequence[str] = P.SENTIMENTS) -> tuple[DataFrame, dict[str, LinearModel]]:
    """Fit all specs on `train` in shared passes, label `val` by all of them in one; log rows and models.

    The log is written: it holds a row per run and no plan of a scored model.
    """
    models = fit_models(train, specs, label, classes)
    labelled = SC.predicted(val, [models[s.run_id] for s in specs], [label])
    runs = F.arrays_zip(F.array(*[F.lit(s.run_id) for s in specs]).alias("run_id"), F.col("labels").alias(PRED))
    scored = labelled.select(F.col(label).alias(EV.TRUE), F.explode(runs).alias("r")).select("r.run_id", EV.TRUE, f"r.{PRED}")
    return cut_lineage(run_log(scored, specs, classes)), models


def pick_winner(log: DataFrame, incumbent: str) -> str:
    """Best macro-F1 if it beats the incumbent, else the incumbent."""
    best = log.orderBy(F.desc("macro_f1"), "run_id").limit(1).head()
    bar = log.filter(F.col("run_id") == incumbent).select("macro_f1").head()[0]
    return best["run_id"] if best["macro_f1"] > bar else incumbent


def select_and_refit(train: DataFrame, val: DataFrame, specs: Sequence[ModelSpec] = EXPERIMENTS, label: str = LABEL) -> tuple[DataFrame, ModelSpec, LinearModel]:
    """Run the sweep with the incumbent, refit the winner on train + val."""
    plan = [INCUMBENT, *specs]
    log, _ = sweep(train, val, plan, label)
    run_id = pick_winner(log, INCUMBENT.run_id)
    winner = next(s for s in plan if s.run_id == run_id)
    return log, winner, fit_model(train.unionByName(val), winner, label=label)


def learnability(df: DataFrame, label: str, classes: Sequence[str], margin: float = 0.05, seed: int = 42) -> DataFrame:
    """Does a linear model on a stratified 80/20 split beat the majority class?"""
    parts = cut_lineage(stratified_split(df, label, "text_id", 0.20, seed), "text_id")
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    settings = P.TfidfParams(max_terms=20_000, min_df=1)
    spec = ModelSpec("learnability", (("word", settings),), "lr")
    model = fit_model(train, spec, label=label, classes=classes)
    scored = EV.overall_metrics(score(model, test, label)).select("accuracy", "macro_f1")
    majority = df.select(F.col(label).alias(EV.TRUE)).withColumn(PRED, EV.majority_label(df, label))
    bar = EV.overall_metrics(majority).select("macro_f1").scalar()
    verdict = F.when(F.col("macro_f1") > bar + margin, "learnable").otherwise("weak")
    return scored.select("accuracy", "macro_f1", bar.alias("majority_macro_f1"), verdict.alias("verdict"))


# ------------------------------------------------------------ inspection
def feature_weights(model: LinearModel, n: int = 15) -> DataFrame:
    """Strongest positive and negative terms per class of a linear model; weights equal to nine digits are ordered by term."""
    table = SC.weight_table(SparkSession.getActiveSession(), model).select("label", "term", F.round("weight", 9).alias("w"))
    ends = [top_per_group(table, ["label"], [order, F.col("term")], n).withColumn("direction", F.lit(name))
            for name, order in (("positive", F.desc("w")), ("negative", F.asc("w")))]
    return ends[0].unionByName(ends[1]).select("label", "direction", "rank", "term", F.round("w", 4).alias("weight"))


# ------------------------------------------- naive Bayes as joins and sums
def naive_bayes_scores(train: DataFrame, rows: DataFrame, text: str = "text_clean", label: str = LABEL, key: str = "text_id", params: P.TfidfParams = P.WORD_TFIDF) -> DataFrame:
    """Multinomial naive Bayes on TF-IDF weights: log score per text and class.

    Class sums are keyed by (class, term) and combine map-side; the table of
    log probabilities is bounded by classes × vocabulary and broadcast.
    """
    vocab = fitted_vocabulary(train, text, key, params)
    weighted = weigh(train, vocab, text, key, params, keep=[label])
    sums = weighted.groupBy(label, "term").agg(F.sum("weight").alias("s"))
    classes = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_texts"))
    n_all = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = vocab.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = sums.groupBy(label).agg(F.sum("s").alias("class_sum"))
    base = classes.join(totals, label, "left").select(
        label,
        F.log(F.col("n_texts") / n_all).alias("log_prior"),
        F.log(F.coalesce("class_sum", F.lit(0.0)) + size).alias("log_total"),
    )
    # a term unseen in a class scores ln(1) - log_total, so only seen pairs are stored
    seen = sums.select(F.col(label).alias("candidate"), "term", F.log(F.col("s") + 1).alias("gain"))
    scored = weigh(rows, vocab, text, key, params)
    mass = scored.groupBy(key).agg(F.sum("weight").alias("mass"))
    gains = (
        scored.join(F.broadcast(seen), "term")
        .groupBy(key, "candidate")
        .agg(F.sum(F.col("weight") * F.col("gain")).alias("gain"))
    )
    ladder = base.agg(
        F.collect_list(F.struct(F.col(label).alias("candidate"), "log_prior", "log_total")).alias("o")
    ).scalar()
    every = rows.select(key).join(mass, key, "left").select(key, F.coalesce("mass", F.lit(0.0)).alias("mass"), F.explode_outer(ladder).alias("c"))
    return (
        every.select(key, "mass", "c.*")
        .join(gains, [key, "candidate"], "left")
        .select(
            key, F.col("candidate").alias("label"),
            (F.col("log_prior") + F.coalesce("gain", F.lit(0.0)) - F.col("mass") * F.col("log_total")).alias("log_score"),
        )
    )


def naive_bayes_labels(scores: DataFrame, key: str = "text_id") -> DataFrame:
    """Best class per text; ties by label. Combined map-side."""
    return scores.groupBy(key).agg(
        F.min_by("label", F.struct((-F.col("log_score")).alias("s"), F.col("label"))).alias(PRED)
    )


def fitted_vocabulary(train: DataFrame, text: str, key: str, params: P.TfidfParams) -> DataFrame:
    """Vocabulary with idf weights, at most `max_terms` rows."""
    tf = TP.term_frequencies(train, key, text, params)
    n_docs = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    return cut_lineage(TP.vocabulary(tf, params).select("term", TP.smooth_idf(n_docs, F.col("df")).alias("idf")))


def weigh(df: DataFrame, vocab: DataFrame, text: str, key: str, params: P.TfidfParams, keep: Sequence[str] = ()) -> DataFrame:
    """Unit-length TF-IDF rows of `df` under a fitted vocabulary."""
    tf = TP.term_frequencies(df, key, text, params, keep, spread=True)
    raw = tf.join(F.broadcast(vocab), "term").withColumn("w", TP.tf_weight(F.col("tf"), params.sublinear) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, *keep, "term", (F.col("w") / norm).alias("weight"))
