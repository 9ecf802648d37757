"""The shared fit against dense solvers, features against the term tables, stored models against joins."""

import cProfile
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.operators import linear as L, models as M, scoring as SC, topics as TP
from chirrup.plans import learning as LN

CLASSES = P.SENTIMENTS
WORD, CHAR = ("word", P.TfidfParams(min_df=1)), ("char", P.TfidfParams(analyzer="char", ngrams=(3, 5), min_df=1))


def rows(n=120, seed=4):
    rng = random.Random(seed)
    words = {c: [f"{c.lower()}{i}" for i in range(6)] for c in CLASSES}
    common = ["the", "and", "día", "\U0001f600x", "a", "über", "ok"]
    out = []
    for i in range(n):
        c = rng.choice(CLASSES + CLASSES[:1])
        t = " ".join(rng.choice(words[c] if rng.random() < 0.3 else words[rng.choice(CLASSES)] if rng.random() < 0.3 else common) for _ in range(rng.randint(1, 12)))
        out.append((i, t, c))
    return [*out, (n, "", CLASSES[0]), (n + 1, None, CLASSES[1]), (n + 2, "no label", None), (n + 3, "other label", "Unknown")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(rows(), "text_id long, text_clean string, sentiment_label string").repartition(3)


def dense(texts, vocabulary):
    found = L.feature_rows(texts.where(F.col("sentiment_label").isin(*CLASSES)), vocabulary, ["text_id", "sentiment_label"]).orderBy("text_id").collect()
    x = np.zeros((len(found), vocabulary.size))
    for i, r in enumerate(found):
        for f in r.features:
            x[i, f["col"]] = f["value"]
    return x, np.array([CLASSES.index(r.sentiment_label) for r in found])


def newton_lr(x, y, c, weight):
    """Dense multinomial Newton steps on the summed loss with a free intercept."""
    n, d = x.shape
    k, xb = 3, np.hstack((x, np.ones((n, 1))))
    w = np.zeros((d + 1, k))
    mask = np.ones((d + 1, k))
    mask[-1] = 0
    for _ in range(60):
        z = xb @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = xb.T @ ((p - np.eye(k)[y]) * weight[:, None]) + mask * w / c
        h = np.zeros(((d + 1) * k, (d + 1) * k))
        for a in range(k):
            for b in range(k):
                s = weight * p[:, a] * ((a == b) - p[:, b])
                h[a * (d + 1) : (a + 1) * (d + 1), b * (d + 1) : (b + 1) * (d + 1)] = xb.T @ (s[:, None] * xb)
        h += np.diag(mask.T.ravel() / c) + 1e-9 * np.eye(len(h))
        w -= np.linalg.solve(h, g.T.ravel()).reshape(k, d + 1).T
    return w - np.vstack((np.zeros((d, k)), np.repeat(w[-1].mean(), k)[None]))


def newton_hinge(x, side, c):
    """Dense generalised Newton steps with halving for the squared hinge; the intercept is penalised."""
    xb = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(xb.shape[1])

    def value(w):
        return 0.5 * w @ w + c * (np.maximum(1 - side * (xb @ w), 0) ** 2).sum()

    for _ in range(100):
        gap = 1 - side * (xb @ w)
        on = gap > 0
        g = w - 2 * c * xb[on].T @ (side[on] * gap[on])
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * xb[on].T @ xb[on], g)
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-10:
            t /= 2
        w = w - t * step
    return w


SPECS = (L.ModelSpec("lr", (WORD,), "lr", tolerance=1e-8), L.ModelSpec("strong", (WORD,), "lr", c=0.3, tolerance=1e-8),
         L.ModelSpec("even", (WORD,), "lr", balanced=True, tolerance=1e-8), L.ModelSpec("svm", (WORD,), "svm", c=0.7, tolerance=1e-8),
         L.ModelSpec("both", (CHAR, WORD), "lr"), L.ModelSpec("nb", (WORD,), "nb"))


@pytest.fixture(scope="module")
def models(texts):
    return L.fit_models(texts, SPECS, "sentiment_label", CLASSES)


def test_features_equal_the_term_table(texts):
    some = texts.where("text_clean IS NOT NULL")
    for part in (WORD, CHAR):
        vocabulary = L.fit_vocabulary(some, (part,))
        names = vocabulary.terms[0].to_pylist()
        got = {(r.text_id, names[f["col"]]): f["value"] for r in L.feature_rows(some, vocabulary, ["text_id"]).collect() for f in r.features}
        want = {(r.text_id, r.term): r.weight for r in TP.tfidf(some, "text_id", "text_clean", part[1]).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_solutions_equal_dense_solvers(texts, models):
    x, y = dense(texts, models["lr"].vocabulary)
    assert len(y) == 122 and not x[-1].any()
    count = np.bincount(y, minlength=3)
    for name, c, weight in (("lr", 1.0, np.ones(len(y))), ("strong", 0.3, np.ones(len(y))), ("even", 1.0, (len(y) / (3 * count))[y])):
        want = newton_lr(x, y, c, weight)
        m = models[name]
        assert np.abs(m.weights - want[:-1]).max() < 1e-4
        assert np.abs((m.intercepts - m.intercepts.mean()) - (want[-1] - want[-1].mean())).max() < 1e-4
    for k in range(3):
        want = newton_hinge(x, np.where(y == k, 1.0, -1.0), 0.7)
        assert np.abs(np.append(models["svm"].weights[:, k], models["svm"].intercepts[k]) - want).max() < 1e-4
    sums = np.array([x[y == k].sum(axis=0) for k in range(3)]).T
    assert np.allclose(models["nb"].weights, np.log((sums + 1) / (sums.sum(axis=0) + x.shape[1])), atol=1e-9)


def test_partial_sums_added_on_the_cluster(texts, models, monkeypatch):
    monkeypatch.setattr(L, "FEW_PARTS", 0)
    again = L.fit_models(texts, SPECS[:1], "sentiment_label", CLASSES)["lr"]
    assert np.abs(again.weights - models["lr"].weights).max() < 1e-6


def test_optimality_is_measured(texts, models):
    convex = [m for m in models.values() if m.spec.algorithm != "nb"]
    got = {r.run_id: r for r in SC.optimality(texts, convex, "sentiment_label").collect()}
    assert set(got) == {"lr", "strong", "even", "svm", "both"} and all(r.optimal for r in got.values())
    for m in (models["lr"], models["svm"]):
        moved = L.LinearModel(m.spec, m.classes, m.vocabulary, m.weights + 1e-3, m.intercepts)
        row = SC.optimality(texts, [moved], "sentiment_label").head()
        assert not row.optimal and row.gradient > 1e-6


def test_stored_model_scores_alike(spark, texts, models, tmp_path):
    for name in ("both", "svm", "nb"):
        path = f"file://{tmp_path}/{name}"
        for _ in range(2):  # storing again replaces
            SC.save_linear(spark, models[name], path)
        again = SC.load_linear(spark, path)
        assert again.spec.config == models[name].spec.config and np.array_equal(again.weights, models[name].weights)
        inside = {r.text_id: r.labels[0] for r in SC.predicted(texts, [again], ["text_id"]).collect()}
        joined = {r.text_id: r.predicted_label for r in SC.labels_by_join(texts, again).collect()}
        assert inside == joined and len(inside) == 124
        assert SC.load_linear(spark, path).classes == CLASSES
    monkey = SC.LOOKUP_ROWS
    try:
        SC.LOOKUP_ROWS = 3
        with pytest.raises(ValueError):
            SC.load_linear(spark, path)
    finally:
        SC.LOOKUP_ROWS = monkey


def test_batch_scoring_and_weights(spark):
    good, bad, plain = "lovely great day", "awful bad mess", "meeting at noon"
    data = [(f"{t} {i}", s) for i in range(30) for t, s in ((good, "Positive"), (bad, "Negative"), (plain, "Neutral"))]
    df = spark.createDataFrame([(j, t, s) for j, (t, s) in enumerate(data)], "text_id long, text_clean string, sentiment_label string")
    for spec in (M.ModelSpec("w", (M.WORD,), "lr"), M.ModelSpec("c", (M.CHAR, M.WORD), "lr", balanced=True), M.ModelSpec("s", (M.WORD,), "svm")):
        model = M.fit_model(df, spec)
        raw = spark.createDataFrame([(1, "What a lovely great day &amp; more"), (2, "awful bad mess"), (3, None)], "text_id long, post_text string")
        full = {r.text_id: r for r in M.batch_scoring(model, raw).collect()}
        assert full[1].label == "Positive" and full[2].label == "Negative" and full[1].text_clean == "What a lovely great day & more" and full[3].raw_text is None
        assert {r.text_id: r.label for r in M.batch_labels(model, raw).collect()} == {k: r.label for k, r in full.items()}
    assert M.feature_weights(model, n=3).filter("label = 'Positive' AND direction = 'positive'").count() == 3


def test_sweep_logs_every_run(texts):
    specs = (M.ModelSpec("a", (WORD,), "lr"), M.ModelSpec("b", (WORD,), "svm"), M.ModelSpec("c", (WORD,), "nb"))
    known = texts.where(F.col("sentiment_label").isin(*CLASSES))
    log, models = M.sweep(known, known, specs)
    rows_ = {r.run_id: r for r in log.collect()}
    assert set(rows_) == set(models) == {"a", "b", "c"}
    for name, m in models.items():
        right = M.score(m, known).where("true_label = predicted_label").count()
        assert abs(rows_[name].accuracy - right / known.count()) < 1e-4
    assert M.pick_winner(log, "a") in rows_


def test_missing_class_and_no_rows(spark, texts):
    two = texts.where(F.col("sentiment_label") != CLASSES[2])
    m = L.fit_models(two, (L.ModelSpec("lr", (WORD,), "lr", tolerance=1e-4), L.ModelSpec("svm", (WORD,), "svm")), "sentiment_label", CLASSES)
    assert {r.labels[0] for r in SC.predicted(texts, [m["lr"]], ["text_id"]).collect()} <= set(CLASSES[:2])
    none = L.fit_models(texts.limit(0), (L.ModelSpec("lr", (WORD,), "lr"),), "sentiment_label", CLASSES)["lr"]
    assert none.vocabulary.size == 0 and {r.labels[0] for r in SC.predicted(texts, [none], ["text_id"]).collect()} == {CLASSES[0]}


def test_solver_reports_its_limit():
    solver = L.lbfgs(np.array([5.0, 5.0]), 1e-9, 3)
    x = next(solver)
    with pytest.raises(RuntimeError, match="no optimum"):
        for _ in range(10):
            x = solver.send((float((x**4).sum()), 4 * x**3))


def test_grams_of_short_words():
    assert L.word_grams("a", 3, 5) == [" a "] and L.word_grams("a", 4, 5) == [" a "]
    assert L.word_grams("ab", 3, 4) == [" ab", "ab ", " ab "]


def test_terms_are_counted_without_a_row_for_each_text(spark, texts):
    doubled = texts.where("text_clean IS NOT NULL").unionByName(spark.createDataFrame([(0, "the the über", CLASSES[0]), (None, "ok ok", CLASSES[0])], texts.schema))
    got = {(r.part, r.term): (r.df, r.total) for r in L.term_counts(doubled, (WORD, CHAR), "text_id", "text_clean").collect()}
    want = {(n, r.term): (r.df, r.total) for n, p in (WORD, CHAR)
            for r in TP.document_frequency(TP.term_frequencies(doubled, "text_id", "text_clean", p)).collect()}
    assert got == want


def test_driver_gets_one_gradient_a_pass(spark, texts, monkeypatch):
    known = texts.where(F.col("sentiment_label").isin(*CLASSES))
    vocabulary = L.fit_vocabulary(known, (WORD, CHAR))
    blocks = L.training_blocks(known, vocabulary, "sentiment_label", CLASSES).repartition(3)
    assert blocks.columns == ["y", "pointer", "col", "val"]
    count = np.ones(3)
    problems = L.problems_of(L.ModelSpec("c", (CHAR,), "lr"), vocabulary, count)
    plain = type(blocks).toArrow
    sizes = []
    monkeypatch.setattr(type(blocks), "toArrow", lambda self: (lambda t: (sizes.append(sum(len(p.as_py()) for p in t.column("part"))), t)[1])(plain(self)))
    L.evaluate(blocks, problems, [np.zeros(p.shape) for p in problems], vocabulary.size, 3)
    assert sizes == [8 * (len(problems) + sum(p.shape[0] * p.width for p in problems))]


def test_optimality_of_repeated_ids(texts):
    twice = texts.where(F.col("sentiment_label").isin(*CLASSES)).withColumn("text_id", F.col("text_id") % 50)
    m = L.fit_models(twice, SPECS[:1], "sentiment_label", CLASSES)
    assert SC.optimality(twice, list(m.values()), "sentiment_label").head().optimal


def test_more_steps_save_passes(texts, models):
    known = texts.where(F.col("sentiment_label").isin(*CLASSES))
    vocabulary = L.fit_vocabulary(known, (WORD,))
    problem = L.problems_of(L.ModelSpec("w", (WORD,), "lr"), vocabulary, np.ones(3))
    assert L.steps_held(problem) == L.MOST_STEPS
    wide = L.Problem("x", "lr", -1, 3, np.arange(100_000), np.ones(3), 1.0, 1.0)
    assert L.steps_held([wide] * 10) == L.FEW_STEPS and 16 * 300_003 * L.steps_held([wide]) <= L.HISTORY_BYTES

    rng = np.random.default_rng(1)
    curve = np.geomspace(1e-4, 1.0, 30)[:, None]
    goal = rng.normal(size=(30, 1))

    def passes(memory):
        solver = L.lbfgs(np.zeros((30, 1)), 1e-6, 2000, 1.0, memory)
        x, n = next(solver), 1
        while True:
            gap = x - goal
            try:
                x = solver.send((0.5 * float((curve * gap * gap).sum()), curve * gap))
                n += 1
            except StopIteration:
                return n

    assert passes(L.MOST_STEPS) < 0.6 * passes(L.FEW_STEPS)


def test_grams_of_all_words_at_once():
    words = pa.array(["skipped", "", "a", "ab", "abc", "\u00e9t\u00e9", "\u65e5\u672c\u8a9e", "\U0001d4b3y", "x" * 30]).slice(1)
    for low, high in ((3, 5), (1, 3), (4, 6)):
        grams, size = L._grams(words, low, high)
        each = [L.word_grams(w, low, high) for w in words.to_pylist()]
        assert grams.to_pylist() == [g for gs in each for g in gs] and size.tolist() == [len(gs) for gs in each]
    many = pa.array([[f"word{i}" for i in range(3000)]])
    with cProfile.Profile() as calls:
        L._counted(many, P.CHAR_TFIDF)
    assert sum(e.callcount for e in calls.getstats()) < 3000  # no Python call a word


def test_a_task_sends_a_term_of_its_runs_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "same words here") for i in range(8)], "text_id long, text_clean string").coalesce(1)
    seen, size = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(size)
    spark.conf.set(size, 1)  # a run of its own for each text
    group = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *by: (seen.append(self) if by == ("part", "term") else None, group(self, *by))[1])
    counted = L.term_counts(docs, (("word", P.TfidfParams(ngrams=(1, 1))),), "text_id", "text_clean")
    assert [tuple(r)[1:] for r in counted.orderBy("term").collect()] == [("here", 8, 8), ("same", 8, 8), ("words", 8, 8)]
    assert seen[-1].count() == 3
    spark.conf.set(size, usual)


def test_blocks_take_few_bytes_an_entry(texts):
    known = texts.where(F.col("sentiment_label").isin(*CLASSES)).coalesce(1)
    vocabulary = L.fit_vocabulary(known, (CHAR, WORD))
    blocks = L.training_blocks(known, vocabulary, "sentiment_label", CLASSES).collect()
    entries = sum(len(r.features) for r in L.feature_rows(known, vocabulary, ["text_id"]).collect())
    assert sum(len(b.col) + len(b.val) for b in blocks) < 5 * entries  # 12 before


def test_packed_blocks_come_back():
    y = np.array([0, 2, 1])
    words = (np.array([2, 0, 3]), np.array([3, 70_000, 1, 255, 509]), np.array([1, 300, 254, 255, 7]), np.array([0.5, 1.0, 2.0]))
    grams = (np.array([0, 1, 0]), np.array([90_000]), np.array([2]), np.array([3.0, 4.0, 5.0]))
    labels, parts = L._unpacked(L._packed(y, [words, grams]), 0)
    assert labels.tolist() == y.tolist() and len(parts) == 2
    for (size, col, tf, norm), (times, column, small, at, wide, length) in zip((words, grams), parts):
        counts = small.astype(int)
        counts[at] = wide
        assert (times.tolist(), column.tolist(), counts.tolist(), length.tolist()) == (size.tolist(), col.tolist(), tf.tolist(), norm.tolist())
    assert L._unpacked(L._packed(y, [tuple(x[:0] if i in (1, 2) else x * 0 for i, x in enumerate(words))]), 0)[1][0][1].tolist() == []


def test_what_all_texts_share_costs_no_passes(spark, monkeypatch):
    rng = random.Random(2)
    common = " ".join(f"all{i}" for i in range(40))
    data = [(i, f"{common} {' '.join(rng.choices([f'{c}{k}' for k in range(5)] + ['x', 'y'], k=4))}", c) for i in range(300) for c in [rng.choice(CLASSES)]]
    df = spark.createDataFrame(data, "text_id long, text_clean string, sentiment_label string").coalesce(2)
    spec = L.ModelSpec("w", (("word", P.TfidfParams(min_df=1, ngrams=(1, 1))),), "lr", c=100.0, tolerance=1e-7)
    plain, passes = L.evaluate, []
    monkeypatch.setattr(L, "evaluate", lambda *a, **k: (passes.append(1), plain(*a, **k))[1])
    L.fit_models(df, (spec,), "sentiment_label", CLASSES)
    assert len(passes) <= 45  # 66 before


def test_optimality_stores_no_features(texts, models, monkeypatch):
    kept = []
    plain, checkpoint = SC.written, type(texts).checkpoint
    monkeypatch.setattr(SC, "written", lambda df, name: (kept.append(df.columns), plain(df, name))[1])
    monkeypatch.setattr(type(texts), "checkpoint", lambda self, *a, **k: (kept.append(self.columns), checkpoint(self, *a, **k))[1])
    assert all(r.optimal for r in SC.optimality(texts, [models["both"], models["svm"]], "sentiment_label").collect())
    assert kept and not any("features" in columns for columns in kept)


def test_margins_of_repeated_ids_shuffle_no_terms(texts, models):
    twice = texts.where("text_clean IS NOT NULL").withColumn("text_id", F.col("text_id") % 40)
    joined = SC.margins_by_join(twice, models["both"])
    assert joined.count() == 3 * twice.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and ", term#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_texts_are_cleaned_once_for_the_split(spark, folder, monkeypatch):
    kept, plain = [], LN.written
    monkeypatch.setattr(LN, "written", lambda df, name: (kept.append(df.columns), plain(df, name))[1])
    got = {r.text_id for part in LN._parts(spark, folder) for r in part.select("text_id").collect()}
    assert got == {r.text_id for r in LN.labelled(spark, folder).select("text_id").collect()}
    assert kept == [["text_id", "text_clean", "sentiment_label"]]
