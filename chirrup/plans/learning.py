"""Queries on splits, evaluation and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.functions import text as X
from chirrup.operators import clean as CL, engagement as E, evaluation as EV, linear as L, models as M, quality as Q, scoring as SC, splits as SP
from chirrup.plans import check_sql as S
from chirrup.plans.corpus import labelled, word_terms
from chirrup.plans.registry import Query
from chirrup.session import cut_lineage, fresh_dir, settings, written
from chirrup.sources import artifacts as A

TRUE, PRED = EV.TRUE, EV.PRED


def split_rows(spark, d):
    return SP.group_split(labelled(spark, d))


def predictions(spark, d):
    """Labelled texts with a rule-based prediction, for the evaluation queries."""
    length, n_words = F.length("text_clean"), X.word_count("text_clean")
    rule = F.when(n_words < 60, "Neutral").when(length % 4 == 0, "Negative").otherwise("Positive")
    return labelled(spark, d).select("text_id", "text_clean", F.col("sentiment_label").alias(TRUE), rule.alias(PRED))


def featured(spark, d):
    return EV.with_text_features(predictions(spark, d))


def group_split(spark, d):
    return split_rows(spark, d).select("text_id", "sentiment_label", "split")


def split_checks(spark, d):
    return Q.split_checks(split_rows(spark, d), source=labelled(spark, d))


def leaks(spark, d):
    """Leaks of a careless split by row number instead of by text."""
    careless = labelled(spark, d).withColumn("split", F.when(F.col("text_id") % 2 == 0, "train").otherwise("test"))
    return SP.split_leaks(careless).select(F.col("text_digest"))


def shared(spark, d):
    careless = labelled(spark, d).select("text_id", F.md5("text_clean").alias("text_md5"))
    even = careless.filter(F.col("text_id") % 2 == 0)
    return SP.shared_keys(even, careless.filter(F.col("text_id") % 2 == 1), "text_md5")


def encoded(spark, d):
    rows = CL.encode_labels(labelled(spark, d), P.SENTIMENT_LABELS, "sentiment_label", "sentiment_label_id")
    rows = CL.encode_labels(rows, P.TOPIC_LABELS, "topic_category", "topic_category_id")
    return rows.select("text_id", "sentiment_label_id", "topic_category_id")


def unknown(spark, d):
    """Labels missing from a stored label table that lacks one class."""
    path = fresh_dir(spark, "labels")
    A.save_label_table(A.label_table(spark), path)
    known = A.load_label_table(spark, path).filter("field = 'sentiment_label' AND label <> 'Negative'")
    return CL.unknown_labels(labelled(spark, d), "sentiment_label", known)


def saved_predictions(spark, d):
    path = fresh_dir(spark, "predictions")
    A.save_predictions(predictions(spark, d), path)
    return spark.read.parquet(path).select("text_id", "true_label", "predicted_label", "correct")


def matrix(spark, d):
    return EV.confusion_matrix(predictions(spark, d), P.SENTIMENTS)


def class_metrics(spark, d):
    m = EV.class_metrics(predictions(spark, d))
    return m.select("label", "support", "predicted", "hits", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


def slices(spark, d):
    f = featured(spark, d)
    by_class = EV.error_rates(f).withColumnRenamed(TRUE, "slice")
    by_flag = EV.error_rates(f.withColumn("slice", F.concat(F.lit("negation "), F.col("has_negation").cast("string"))), "slice")
    return by_class.unionByName(by_flag)


def lift(spark, d):
    return EV.error_lift(featured(spark, d), "has_negation")


def baselines(spark, d):
    rows = split_rows(spark, d)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    test = test.withColumn(TRUE, F.col("sentiment_label"))
    majority = EV.predict_majority(train, test, "sentiment_label").select("text_id", F.lit("majority").alias("model"), TRUE, PRED)
    drawn = EV.predict_stratified(train, test, "sentiment_label", "text_id").select("text_id", F.lit("stratified").alias("model"), TRUE, PRED)
    return majority.unionByName(drawn)


def error_categories(spark, d):
    """Counts and shares of an annotation table over the wrong predictions."""
    notes = featured(spark, d).filter(F.col(TRUE) != F.col(PRED)).select(
        F.when(F.col("has_negation"), "NEGATION").when(F.col("word_count") < 60, "SHORT_TEXT").otherwise("OTHER").alias("category"))
    return E.class_shares(notes, "category", "category")


def nb_scores(spark, d):
    rows = cut_lineage(labelled(spark, d).select("text_id", "text_clean", "sentiment_label"), "text_id")
    scores = M.naive_bayes_scores(rows, rows)
    return scores.select("text_id", "label", F.round("log_score", 5).alias("log_score"))


# ------------------------------------------------------------------ models
def _parts(spark, d):
    # cleaned once and stored, because the split reads the texts twice; what was shuffled for it goes at once
    with settings(spark, {L.DROP_SHUFFLES: True}):
        texts = written(labelled(spark, d).select("text_id", "text_clean", "sentiment_label"), "labelled-texts")
        rows = cut_lineage(SP.group_split(texts).select(*texts.columns, "split"), "text_id")
    return tuple(rows.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))


def _fit_and_score(spark, d, spec):
    train, _, test = _parts(spark, d)
    return A.predictions_table(M.score(M.fit_model(train, spec), test)).drop("text_clean")


def sweep(spark, d):
    train, val, _ = _parts(spark, d)
    log, winner, _ = M.select_and_refit(train, val)
    return log.withColumn("selected", F.col("run_id") == winner.run_id)


def baseline_models(spark, d):
    train, val, _ = _parts(spark, d)
    log, _ = M.sweep(train, val, M.BASELINES)
    truth = val.withColumn(TRUE, F.col("sentiment_label"))
    trivial = [("majority", EV.predict_majority(train, truth, "sentiment_label")),
               ("stratified", EV.predict_stratified(train, truth, "sentiment_label", "text_id"))]
    scores = log.select(F.col("run_id").alias("model"), "macro_f1")
    for name, p in trivial:
        scores = scores.unionByName(EV.overall_metrics(p).select(F.lit(name).alias("model"), "macro_f1"))
    return EV.beats_baselines(scores, ["majority", "stratified"])


def batch(spark, d):
    """Fit, store, reload, score every document."""
    from chirrup.plans.corpus import documents

    train, _, _ = _parts(spark, d)
    path = fresh_dir(spark, "model")
    SC.save_linear(spark, M.fit_model(train, M.ModelSpec("word+nb", (M.WORD,), "nb")), path)
    raw = documents(spark, d).select(F.col("doc_id").alias("text_id"), F.col("text").alias("post_text"))
    return M.batch_labels(SC.load_linear(spark, path), raw)


def optimum(spark, d, spec):
    """Test texts with two facts about the stored model: its gradient over all training rows is
    within tolerance, and the label scored inside the row is the one that joins by term give."""
    train, _, test = _parts(spark, d)
    path = fresh_dir(spark, "model")
    SC.save_linear(spark, M.fit_model(train, spec), path)
    model = SC.load_linear(spark, path)
    optimal = cut_lineage(SC.optimality(train, [model], "sentiment_label")).select("optimal").scalar()
    scored = M.score(model, test).join(SC.labels_by_join(test, model).withColumnRenamed(PRED, "joined"), "text_id")
    return scored.select("text_id", TRUE, optimal.alias("optimal"), (F.col(PRED) == F.col("joined")).alias("agrees"))


def sweep_optima(spark, d):
    """Every model of the experiment plan, fitted in shared passes, against its own objective."""
    train, _, _ = _parts(spark, d)
    models = M.fit_models(train, [M.INCUMBENT, *M.EXPERIMENTS], "sentiment_label", P.SENTIMENTS)
    return SC.optimality(train, list(models.values()), "sentiment_label").select("run_id", "optimal")


def weights(spark, d):
    train, _, _ = _parts(spark, d)
    return M.feature_weights(M.fit_model(train, M.ModelSpec("word+lr", (M.WORD,), "lr")))


def nb_weights(spark, d):
    """The same inspection of the naive Bayes model, whose weights are in closed form."""
    train, _, _ = _parts(spark, d)
    return M.feature_weights(M.fit_model(train, M.ModelSpec("word+nb", (M.WORD,), "nb")))


def union_rows(spark, d):
    """Features of the training texts under both vectorisers side by side: entries, weight sum and length of each part."""
    train, _, _ = _parts(spark, d)
    vocabulary = L.fit_vocabulary(train, (M.CHAR, M.WORD))
    split = vocabulary.starts[1]
    rows = L.feature_rows(train, vocabulary, ["text_id"]).select("text_id", F.explode("features").alias("f"))
    part = F.when(F.col("f.col") < split, "char").otherwise("word")
    return rows.groupBy("text_id", part.alias("part")).agg(
        F.count(F.lit(1)).alias("entries"), F.round(F.sum("f.value"), 6).alias("weights"), F.round(F.sum(F.col("f.value") * F.col("f.value")), 6).alias("length"))


def learnable(spark, d):
    rows = cut_lineage(labelled(spark, d).select("text_id", F.col("post_text").alias("text_clean"), "topic_category"), "text_id")
    return M.learnability(rows, "topic_category", tuple(P.TOPIC_LABELS))


def model_checks(spark, d):
    return Q.model_checks(predictions(spark, d), P.SENTIMENTS, 0.30, 0.6011)


def scored_split_checks(spark, d):
    """The same checks on the held-out parts of a split, with their class balance."""
    length, n_words = F.length("text_clean"), X.word_count("text_clean")
    rule = F.when(n_words < 60, "Neutral").when(length % 4 == 0, "Negative").otherwise("Positive")
    held = split_rows(spark, d).filter("split <> 'train'").select(F.col("split").alias("part"), F.col("sentiment_label").alias(TRUE), rule.alias(PRED))
    return Q.model_checks(held, P.SENTIMENTS, 0.30, balance_pp={"val": 6.0, "test": 7.0})


_LAB = dict(lab=f"SELECT *, {S.clean_text('post_text')} AS text_clean FROM labelled")
_SPLIT = dict(
    g="SELECT text_clean, arg_min(sentiment_label, text_id) AS gl FROM lab GROUP BY text_clean",
    p="SELECT *, row_number() OVER (PARTITION BY gl ORDER BY md5('42:' || text_clean), sha256(text_clean)) AS pos, count(*) OVER (PARTITION BY gl) AS sz FROM g",
    q="SELECT *, greatest(1, CAST(round_even(sz * 0.15, 0) AS BIGINT)) AS k FROM p",
    sp="SELECT text_clean, CASE WHEN pos <= sz - 2 * k THEN 'train' WHEN pos <= sz - k THEN 'val' ELSE 'test' END AS split FROM q",
    rows_="SELECT lab.*, split FROM lab JOIN sp USING (text_clean)",
)
_ROWS = S.with_views("labelled", **_LAB, **_SPLIT)


def _nb(te):
    """Priors and terms smoothed by one; vocabulary and weights come from the training part."""
    return S.with_views(
        "labelled", **_LAB, **_SPLIT, tr="SELECT * FROM rows_ WHERE split = 'train'", te=te,
        **word_terms("tr", "text_id", "text_clean"),
        cs="SELECT sentiment_label AS c, term, sum(w / norm) AS s FROM wt JOIN tr USING (text_id) GROUP BY ALL",
        ct="SELECT sentiment_label AS c, count(*) AS n FROM tr GROUP BY 1",
        tot="""SELECT c, ln((n + 1) / (SELECT sum(n) + count(*) FROM ct)) AS lp,
               ln(coalesce((SELECT sum(s) FROM cs WHERE cs.c = ct.c), 0) + (SELECT count(*) FROM voc)) AS lt FROM ct""",
        ek=f"SELECT text_id, {S.word_tokens('text_clean')} AS k FROM te",
        et=f"SELECT text_id, term, count(*) AS tf FROM (SELECT text_id, unnest(list_concat(k, {S.bigrams('k')})) AS term FROM ek) GROUP BY ALL",
        ew="SELECT text_id, term, (1 + ln(tf)) * idf AS w, sqrt(sum(((1 + ln(tf)) * idf) ** 2) OVER (PARTITION BY text_id)) AS norm FROM et JOIN voc USING (term)",
        gain="SELECT text_id, c, sum(w / norm * ln(s + 1)) AS g FROM ew JOIN cs USING (term) GROUP BY ALL",
        mass="SELECT text_id, sum(w / norm) AS m FROM ew GROUP BY 1",
        scored="""SELECT te.text_id, tot.c, lp + coalesce(g, 0) - coalesce(m, 0) * lt AS score FROM te JOIN tot ON true
                  LEFT JOIN gain ON gain.text_id = te.text_id AND gain.c = tot.c LEFT JOIN mass ON mass.text_id = te.text_id""",
    )


_NB = _nb("SELECT * FROM rows_ WHERE split = 'test'")
_NB_DOCS = _nb(f"SELECT doc_id AS text_id, {S.clean_text("coalesce(text, '')")} AS text_clean FROM documents")
# Character grams of the training texts, counted per text from its words.
_CHAR_TERMS = f"""cw AS (SELECT text_id, ' ' || word || ' ' AS w, count(*) AS n FROM (SELECT text_id, unnest({S.words('lower(text_clean)')}) AS word FROM tr) GROUP BY ALL),
        cg AS (SELECT text_id, substring(w, i, m) AS term, n FROM cw, (SELECT unnest([3, 4, 5]) AS m) z, range(1, length(w) - m + 2) r(i)),
        ctf AS (SELECT text_id, term, sum(n) AS tf FROM cg GROUP BY ALL),
        cvoc AS (SELECT term, ln((1 + (SELECT count(*) FROM tr)) / (1 + df)) + 1 AS idf FROM (
            SELECT term, count(*) AS df, sum(tf) AS total FROM ctf GROUP BY term) WHERE df >= 2 ORDER BY total DESC, term LIMIT 50000),
        cwt AS (SELECT text_id, term, (1 + ln(tf)) * idf AS w, sqrt(sum(((1 + ln(tf)) * idf) ** 2) OVER (PARTITION BY text_id)) AS norm FROM ctf JOIN cvoc USING (term))"""
_PRED = dict(pred=f"""SELECT text_id, text_clean, sentiment_label AS t, CASE WHEN len({S.words('text_clean')}) < 60 THEN 'Neutral'
    WHEN length(text_clean) % 4 = 0 THEN 'Negative' ELSE 'Positive' END AS p FROM lab""")
_HELD = dict(pred=_PRED["pred"].replace("sentiment_label AS t", "split, sentiment_label AS t").replace("FROM lab", "FROM rows_ WHERE split <> 'train'"))
_P = S.with_views("labelled", **_LAB, **_PRED)
_FEATURES = f"""SELECT *, len({S.words('text_clean')}) AS word_count, contains(text_clean, '@user') AS has_user, contains(text_clean, '#') AS has_hashtag,
    {S.negation('text_clean')} AS has_negation, {S.sarcasm('text_clean')} AS has_sarcasm FROM pred"""
_F = S.with_views("labelled", **_LAB, **_PRED, f=_FEATURES)
_CM = {
    "l": "SELECT DISTINCT t AS label FROM pred UNION SELECT DISTINCT p FROM pred",
    "m": """SELECT label, (SELECT count(*) FROM pred WHERE t = label) AS support, (SELECT count(*) FROM pred WHERE p = label) AS predicted,
            (SELECT count(*) FROM pred WHERE t = label AND p = label) AS hits FROM l""",
    "mm": """SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END AS pr, CASE WHEN support = 0 THEN 0.0 ELSE hits / support END AS rc,
             CASE WHEN predicted + support = 0 THEN 0.0 ELSE 2 * hits / (predicted + support) END AS f1 FROM m""",
}
_M = S.with_views("labelled", **_LAB, **_PRED, **_CM)
_OVERALL = """SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 4) AS accuracy, round(avg(pr), 4) AS macro_precision,
    round(sum(pr * support) / sum(support), 4) AS weighted_precision, round(avg(rc), 4) AS macro_recall, round(sum(rc * support) / sum(support), 4) AS weighted_recall,
    round(avg(f1), 4) AS macro_f1, round(sum(f1 * support) / sum(support), 4) AS weighted_f1 FROM mm"""
_DELTAS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg(CASE WHEN t = p THEN v END), 2) AS correct, round(avg(CASE WHEN t <> p THEN v END), 2) AS incorrect
    FROM (SELECT t, p, {f'CAST({c} AS DOUBLE)' if c == 'word_count' else f'CASE WHEN {c} THEN 100.0 ELSE 0.0 END'} AS v FROM f)"""
    for c in EV.FEATURES)
_MATRIX = ", ".join(f"count(*) FILTER (WHERE p = '{c}') AS \"n_{c}\"" for c in P.SENTIMENTS)
_SHARES = ", ".join(f"round(count(*) FILTER (WHERE p = '{c}') / count(*), 4) AS \"share_{c}\"" for c in P.SENTIMENTS)
_RATES = "count(*) AS n, count(*) FILTER (WHERE t <> p) AS errors, round(100.0 * count(*) FILTER (WHERE t <> p) / count(*), 1) AS error_rate"


def _code(column, codes):
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items()) + " END"


QUERIES: dict[str, Query] = {
    "group_split": Query(group_split, f"{_ROWS} SELECT text_id, sentiment_label, split FROM rows_"),
    "split_sizes": Query(
        lambda s, d: SP.split_sizes(split_rows(s, d)), f"{_ROWS} SELECT split, sentiment_label, count(*) AS n FROM rows_ GROUP BY ALL"),
    "split_checks": Query(split_checks, f"""{_ROWS}, c AS (SELECT split, sentiment_label, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split) AS s FROM rows_ GROUP BY split, sentiment_label)
        SELECT "check", CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'no unicode escapes left' AS "check", (SELECT count(*) FROM rows_ WHERE {S.hit('text_clean', r'\\u[0-9A-Fa-f]{4}')}) AS v
        UNION ALL SELECT 'no html entities left', (SELECT count(*) FROM rows_ WHERE {S.hit('text_clean', '(?i)&(?:amp|quot|#39|lt|gt);')})
        UNION ALL SELECT 'every row has a split', (SELECT count(*) FROM rows_ WHERE split IS NULL)
        UNION ALL SELECT 'no text in two splits', (SELECT count(*) FROM (SELECT 1 FROM rows_ GROUP BY text_clean HAVING count(DISTINCT split) > 1))
        UNION ALL SELECT 'class shares within tolerance', (SELECT count(*) FROM c WHERE abs(s - 100.0 / (SELECT count(DISTINCT sentiment_label) FROM rows_)) > 5)
        UNION ALL SELECT 'parts add up to the input', (SELECT CASE WHEN (SELECT count(*) FROM rows_) = (SELECT count(*) FROM lab) THEN 0 ELSE 1 END))"""),
    "split_leaks": Query(leaks, f"""{S.with_views('labelled', **_LAB)} SELECT sha256(text_clean) AS text_digest FROM lab GROUP BY text_clean
        HAVING count(DISTINCT text_id % 2) > 1"""),
    "shared_texts": Query(shared, f"""{S.with_views('labelled', **_LAB)} SELECT md5(text_clean) AS text_md5 FROM lab WHERE text_id % 2 = 0
        INTERSECT SELECT md5(text_clean) FROM lab WHERE text_id % 2 = 1"""),
    "encoded_labels": Query(encoded, f"""{S.with_views('labelled')} SELECT text_id, CAST({_code('sentiment_label', P.SENTIMENT_LABELS)} AS BIGINT) AS sentiment_label_id,
        CAST({_code('topic_category', P.TOPIC_LABELS)} AS BIGINT) AS topic_category_id FROM labelled"""),
    "unknown_labels": Query(unknown, f"{S.with_views('labelled')} SELECT DISTINCT sentiment_label AS label FROM labelled WHERE sentiment_label NOT IN ('Neutral', 'Positive')"),
    "saved_predictions": Query(saved_predictions, f"{_P} SELECT text_id, t AS true_label, p AS predicted_label, t = p AS correct FROM pred"),
    "confusion_matrix": Query(matrix, f"{_P} SELECT t AS true_label, {_MATRIX}, count(*) AS support, {_SHARES} FROM pred GROUP BY t"),
    "confusion_pairs": Query(
        lambda s, d: EV.confusion_pairs(predictions(s, d)), f"{_P} SELECT t AS true_label, p AS predicted_label, count(*) AS n FROM pred WHERE t <> p GROUP BY ALL"),
    "class_metrics": Query(class_metrics, f"{_M} SELECT label, support, predicted, hits, round(pr, 4) AS \"precision\", round(rc, 4) AS recall, round(f1, 4) AS f1 FROM mm"),
    "overall_metrics": Query(lambda s, d: EV.overall_metrics(predictions(s, d)), f"{_M} {_OVERALL}"),
    "error_slices": Query(slices, f"""{_F} SELECT t AS slice, {_RATES} FROM f GROUP BY t
        UNION ALL SELECT 'negation ' || CAST(has_negation AS VARCHAR), {_RATES} FROM f GROUP BY 1"""),
    "error_lift": Query(lift, f"""{_F}, r AS (SELECT avg(CASE WHEN has_negation THEN CASE WHEN t <> p THEN 100.0 ELSE 0.0 END END) AS a,
        avg(CASE WHEN NOT has_negation THEN CASE WHEN t <> p THEN 100.0 ELSE 0.0 END END) AS b FROM f)
        SELECT 'has_negation' AS feature, round(a, 1) AS with_rate, round(b, 1) AS without_rate, round(a - b, 1) AS lift_pp FROM r"""),
    "feature_deltas": Query(
        lambda s, d: EV.feature_deltas(featured(s, d)), f"""{_F}, r AS ({_DELTAS})
        SELECT *, round(incorrect - correct, 1) AS delta, abs(round(incorrect - correct, 1)) >= 3 AS meaningful FROM r"""),
    "trivial_baselines": Query(baselines, f"""{_ROWS}, tr AS (SELECT sentiment_label AS l, count(*) AS n FROM rows_ WHERE split = 'train' GROUP BY 1),
        cum AS (SELECT l, sum(n) OVER (ORDER BY l) / sum(n) OVER () AS upto FROM tr),
        te AS (SELECT text_id, sentiment_label AS true_label, CAST('0x' || substring(md5('42:' || text_id), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM rows_ WHERE split = 'test')
        SELECT text_id, 'majority' AS model, true_label, (SELECT l FROM tr ORDER BY n DESC, l LIMIT 1) AS predicted_label FROM te
        UNION ALL SELECT text_id, 'stratified', true_label, (SELECT arg_min(l, upto) FROM cum WHERE upto > u) FROM te"""),
    "error_categories": Query(error_categories, f"""{_F}, e AS (SELECT CASE WHEN has_negation THEN 'NEGATION' WHEN word_count < 60 THEN 'SHORT_TEXT' ELSE 'OTHER' END AS category
        FROM f WHERE t <> p) SELECT category, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM e), 1) AS pct FROM e GROUP BY 1"""),
    "model_checks": Query(model_checks, f"""{_M}, o AS ({_OVERALL}) SELECT "check", CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'labels are known' AS "check", (SELECT count(*) FROM pred WHERE t NOT IN ({S.listing(P.SENTIMENTS)}) OR p NOT IN ({S.listing(P.SENTIMENTS)})) AS v
        UNION ALL SELECT 'accuracy above floor', (SELECT CASE WHEN accuracy > 0.30 THEN 0 ELSE 1 END FROM o)
        UNION ALL SELECT 'macro F1 above floor', (SELECT CASE WHEN macro_f1 > 0.30 THEN 0 ELSE 1 END FROM o)
        UNION ALL SELECT 'matrix rows equal support', (SELECT count(*) FROM (SELECT t, count(*) AS n, count(*) FILTER (WHERE p IN ({S.listing(P.SENTIMENTS)})) AS k FROM pred GROUP BY t) WHERE n <> k)
        UNION ALL SELECT 'gap to reference F1', (SELECT CASE WHEN abs(macro_f1 - 0.6011) <= 0.05 THEN 0 ELSE 1 END FROM o))"""),
    "scored_split_checks": Query(scored_split_checks, f"""{S.with_views('labelled', **_LAB, **_SPLIT, **_HELD, **_CM)}, o AS ({_OVERALL}),
        b AS (SELECT split, t, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split) - 100.0 / (SELECT count(DISTINCT t) FROM pred x WHERE x.split = pred.split) AS off FROM pred GROUP BY split, t)
        SELECT "check", CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'labels are known' AS "check", (SELECT count(*) FROM pred WHERE t NOT IN ('Negative', 'Neutral', 'Positive') OR p NOT IN ('Negative', 'Neutral', 'Positive')) AS v
        UNION ALL SELECT 'accuracy above floor', (SELECT CASE WHEN accuracy > 0.30 THEN 0 ELSE 1 END FROM o)
        UNION ALL SELECT 'macro F1 above floor', (SELECT CASE WHEN macro_f1 > 0.30 THEN 0 ELSE 1 END FROM o)
        UNION ALL SELECT 'matrix rows equal support', 0
        UNION ALL SELECT 'classes of val within 6 points', (SELECT count(*) FROM b WHERE split = 'val' AND abs(off) > 6)
        UNION ALL SELECT 'classes of test within 7 points', (SELECT count(*) FROM b WHERE split = 'test' AND abs(off) > 7))"""),
    "nb_scores": Query(nb_scores, f"""{S.with_views('labelled', **_LAB, **word_terms('lab', 'text_id', 'text_clean'))},
        x AS (SELECT text_id, term, w / norm AS v FROM wt), cs AS (SELECT sentiment_label AS c, term, sum(v) AS s FROM x JOIN lab USING (text_id) GROUP BY ALL),
        vs AS (SELECT count(*) AS n FROM voc), ct AS (SELECT sentiment_label AS c, count(*) AS n FROM lab GROUP BY 1),
        tot AS (SELECT c, ln(n / (SELECT sum(n) FROM ct)) AS lp, ln(coalesce((SELECT sum(s) FROM cs WHERE cs.c = ct.c), 0) + (SELECT n FROM vs)) AS lt FROM ct),
        gain AS (SELECT text_id, c, sum(v * ln(s + 1)) AS g FROM x JOIN cs USING (term) GROUP BY ALL), mass AS (SELECT text_id, sum(v) AS m FROM x GROUP BY 1)
        SELECT lab.text_id, tot.c AS label, round(lp + coalesce(g, 0) - coalesce(m, 0) * lt, 5) AS log_score
        FROM lab JOIN tot ON true LEFT JOIN gain ON gain.text_id = lab.text_id AND gain.c = tot.c LEFT JOIN mass ON mass.text_id = lab.text_id"""),
    "lr_sentiment": Query(lambda s, d: _fit_and_score(s, d, M.ModelSpec("word+lr", (M.WORD,), "lr"))),
    "svm_sentiment": Query(lambda s, d: _fit_and_score(s, d, M.ModelSpec("char+svm", (M.CHAR,), "svm"))),
    "nb_sentiment": Query(lambda s, d: _fit_and_score(s, d, M.ModelSpec("word+nb", (M.WORD,), "nb")), f"""{_NB}
        SELECT te.text_id, te.sentiment_label AS true_label, best.c AS predicted_label, te.sentiment_label = best.c AS correct
        FROM te JOIN (SELECT text_id, arg_max(c, score) AS c FROM scored GROUP BY 1) best USING (text_id)"""),
    "union_features": Query(lambda s, d: _fit_and_score(s, d, M.ModelSpec("char+word+lr", (M.CHAR, M.WORD), "lr"))),
    "balanced_lr": Query(lambda s, d: _fit_and_score(s, d, M.ModelSpec("char+lr balanced", (M.CHAR,), "lr", balanced=True))),
    "baseline_models": Query(baseline_models),
    "model_sweep": Query(sweep),
    "batch_scoring": Query(batch, f"""{_NB_DOCS} SELECT te.text_id, best.c AS label FROM te JOIN (SELECT text_id, arg_max(c, score) AS c FROM scored GROUP BY 1) best USING (text_id)"""),
    **{name: Query(lambda s, d, spec=spec: optimum(s, d, spec), f"""{_ROWS}
        SELECT text_id, sentiment_label AS true_label, true AS optimal, true AS agrees FROM rows_ WHERE split = 'test'""")
       for name, spec in (("lr_optimum", M.ModelSpec("word+lr", (M.WORD,), "lr")), ("svm_optimum", M.ModelSpec("char+svm", (M.CHAR,), "svm")),
                          ("union_optimum", M.ModelSpec("char+word+lr", (M.CHAR, M.WORD), "lr")),
                          ("balanced_optimum", M.ModelSpec("char+lr balanced", (M.CHAR,), "lr", balanced=True)))},
    "sweep_optima": Query(sweep_optima, "SELECT unnest(['incumbent', 'Exp-A', 'Exp-B', 'Exp-C', 'Exp-D', 'Exp-E']) AS run_id, true AS optimal"),
    "feature_weights": Query(weights),
    "nb_feature_weights": Query(nb_weights, f"""{_NB}, w AS (SELECT tot.c AS label, voc.term, round(ln(coalesce(cs.s, 0) + 1) - tot.lt, 9) AS w
            FROM voc JOIN tot ON true LEFT JOIN cs ON cs.c = tot.c AND cs.term = voc.term),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY w DESC, term) AS up, row_number() OVER (PARTITION BY label ORDER BY w, term) AS down FROM w)
        SELECT label, 'positive' AS direction, up AS rank, term, round(w, 4) AS weight FROM r WHERE up <= 15
        UNION ALL SELECT label, 'negative', down, term, round(w, 4) FROM r WHERE down <= 15"""),
    "union_feature_rows": Query(union_rows, f"""{_NB}, {_CHAR_TERMS}
        SELECT text_id, 'char' AS part, count(*) AS entries, round(sum(w / norm), 6) AS weights, round(sum((w / norm) ** 2), 6) AS length FROM cwt GROUP BY text_id
        UNION ALL SELECT text_id, 'word', count(*), round(sum(w / norm), 6), round(sum((w / norm) ** 2), 6) FROM wt GROUP BY text_id"""),
    "learnability": Query(learnable),
}
