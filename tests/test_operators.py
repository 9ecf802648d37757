"""Operators on small fixtures: golden events, skew, ties, quantiles, streams."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C
from chirrup.operators import clean as CL, engagement as E, evaluation as EV, quality as Q, ranking as R, splits as SP
from chirrup.operators import timeline as TL, triggers as TR
from chirrup.sources import artifacts as A, collect as CO, files as FI, roles

HOURS = [
    # fixed values: post count, engagement, % negative, neutral, positive per hour from 21:00
    (14, 7, 50.0, 21.43, 28.57), (13, 43, 15.38, 46.15, 38.46), (14, 30, 21.43, 35.71, 42.86), (11, 3, 18.18, 18.18, 63.64),
    (12, 22, 0.0, 58.33, 41.67), (12, 4, 16.67, 50.0, 33.33), (4, 0, 0.0, 100.0, 0.0), (13, 5, 23.08, 38.46, 38.46),
    (11, 8, 27.27, 36.36, 36.36), (18, 41, 27.78, 33.33, 38.89), (16, 2, 25.0, 18.75, 56.25), (14, 70, 28.57, 42.86, 28.57),
    (16, 32, 25.0, 56.25, 18.75), (28, 25, 28.57, 39.29, 32.14), (26, 8, 7.69, 30.77, 61.54), (65, 66, 30.77, 36.92, 32.31),
    (85, 151, 24.71, 36.47, 38.82), (94, 109, 31.91, 34.04, 34.04), (72, 90, 36.11, 29.17, 34.72), (48, 37, 41.67, 39.58, 18.75),
    (0, 0, 0.0, 0.0, 0.0), (1, 0, 0.0, 100.0, 0.0),
]


def timeline_of(spark, hours):
    start = dt.datetime(2026, 9, 21, 21)
    rows = [(start + dt.timedelta(hours=i), *h) for i, h in enumerate(hours)]
    return spark.createDataFrame(
        rows, "hour timestamp, post_count long, total_engagement long, pct_negative double, pct_neutral double, pct_positive double")


def test_golden_events(spark):
    events = TL.detect_events(timeline_of(spark, HOURS)).orderBy("event_id").collect()
    assert [e["event_id"] for e in events] == [f"EVT_{i:03d}" for i in range(1, 12)]
    assert [e["event_type"] for e in events].count("sentiment_shift") == 10
    spike = events[9]
    assert (spike["event_type"], spike["metric_value"], spike["delta_or_zscore"], spike["threshold"]) == (
        "engagement_spike", 151.0, 2.884, 115.2068)
    assert [round(e["delta_or_zscore"], 2) for e in events if e["event_type"] == "sentiment_shift"] == [
        44.51, 24.03, -25.01, -16.66, 15.38, 20.14, -31.25, 50.28, -52.31, -21.53]


def test_fallback_and_single_bucket(spark):
    calm = [(10, 5, 30.0, 40.0, 30.0), (10, 6, 30.0, 29.0, 41.0), (10, 7, 30.0, 30.0, 40.0), (10, 8, 30.0, 30.0, 40.0)]
    kinds = [(e["event_type"], e["threshold"]) for e in TL.detect_events(timeline_of(spark, calm)).collect()]
    assert ("sentiment_shift", 10.0) in kinds and any(k == "engagement_spike" for k, _ in kinds)
    alone = TL.detect_events(timeline_of(spark, calm[:1])).collect()
    assert [e["event_type"] for e in alone] == ["engagement_spike"] and alone[0]["delta_or_zscore"] == 0.0


def test_timeline_rounding_and_gaps(spark):
    rows = [("2024-01-01T00:10:00Z", 2 if i == 0 else 0) for i in range(16)] + [("2024-01-01T05:30:00+02:00", 1)]
    posts = spark.createDataFrame(
        [(t, "2024-02-01T00:00:00Z", str(n), "", "0", None, "Odd") for t, n in rows],
        "created_at string, collected_at string, like_count string, repost_count string, reply_count string, quote_count string, sentiment_label string")
    got = TL.hourly_timeline(posts).orderBy("hour").collect()
    assert [r["post_count"] for r in got] == [16, 0, 0, 1]
    assert got[0]["avg_engagement"] == 0.12 and got[0]["pct_neutral"] == 100.0 and got[1]["pct_neutral"] == 0.0


@pytest.mark.parametrize("kind", ["uniform", "hot", "heavy_tail"])
def test_order_statistics_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(R, "_SMALL", 50)
    monkeypatch.setattr(R, "_SKETCH_ACCURACY", 100)
    rng = np.random.default_rng(1)
    v = {"uniform": rng.integers(0, 1000, 5000), "hot": np.where(rng.random(5000) < 0.4, 7, rng.integers(0, 9999, 5000)),
         "heavy_tail": (rng.pareto(1.0, 5000) * 10).astype(int)}[kind]
    df = spark.createDataFrame([(int(x),) for x in v], "v long").repartition(4)
    got = R.exact_quantiles(df, "v", ["0.1", "0.5", "0.9"])
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(v, float(p)))


def test_positions_are_a_global_rank(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("s")).withColumn("o", F.md5(F.col("id").cast("string")))
    rows = R.positions_in_strata(df, "s", "o", "id").collect()
    for s in ("x", "y"):
        mine = sorted((r["o"], r["position"], r["stratum_size"]) for r in rows if r["s"] == s)
        assert [p for _, p, _ in mine] == list(range(1, len(mine) + 1))
        assert {n for _, _, n in mine} == {len(mine)}


def test_rank_ties_stay(spark):
    df = spark.createDataFrame([("a", 9), ("a", 8), ("a", 7), ("a", 7), ("a", 7), ("a", 1)], "g string, v int")
    assert R.top_per_group(df, ["g"], [F.desc("v")], 3, ties=True).count() == 5


def test_hot_group_split_keeps_copies_together(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", ["Negative", "Neutral", "Positive"][i % 2 if i % 3 else 0]) for i in range(600)]
    df = spark.createDataFrame(rows, "text_id long, text_clean string, sentiment_label string")
    split = SP.group_split(df)
    assert split.count() == 600
    assert SP.split_leaks(split).count() == 0
    assert {r[0] for r in split.select("split").distinct().collect()} == {"train", "val", "test"}


def test_merge_first_seen(spark):
    old = spark.createDataFrame([("u1", "old", 5)], "post_uri string, query_term string, arrival long")
    new = spark.createDataFrame([("u1", "q", 1), ("u2", "b", 9), ("u2", "a", 2), ("", "x", 1), (None, "y", 1)], old.schema)
    got = {r["post_uri"]: (r["query_term"], r["is_new"]) for r in CO.merge_first_seen(old, new).collect()}
    assert got == {"u1": ("old", 0), "u2": ("a", 1)}


def test_relevance_halves_add_up(spark, folder):
    judged = CL.judge_relevance(roles.document_posts(spark, folder))
    kept, dropped = CL.relevant_posts(judged).count(), CL.exclusion_log(judged, "post_id").count()
    assert kept + dropped == judged.count() and kept > 0 and dropped > 0


def test_cleaning_restores_the_typed_posts(spark, folder):
    got = CL.clean_posts(roles.dirty_posts(spark, folder))
    want = roles.posts(spark, folder)
    joined = got.join(want.select(F.col("post_id").cast("string").alias("post_id"), F.col("likes").alias("l"), F.col("platform").alias("p")), "post_id")
    assert got.count() == want.count() == joined.count()
    assert joined.filter(~F.col("likes").eqNullSafe(F.col("l")) | ~F.col("platform").eqNullSafe(F.col("p"))).count() == 0


def test_unknown_label_fails(spark):
    df = spark.createDataFrame([("Happy",)], "l string")
    with pytest.raises(Exception, match="unknown label"):
        CL.encode_labels(df, P.SENTIMENT_LABELS, "l", "i").collect()


def test_bad_strict_number_fails(spark):
    with pytest.raises(Exception):
        CL.clean_users(spark.createDataFrame([("1", "a", "b", "2020-01-01", "x")], FI.text_schema(FI.RAW_USERS))).collect()


def test_trigger_bounds_are_strict(spark):
    t0 = dt.datetime(2024, 1, 2, 12)
    events = spark.createDataFrame([("E1", "sentiment_shift", t0, "camera")], "event_id string, event_type string, timestamp timestamp, topic string")
    hours = [(-24, "apple early"), (-23, "apple camera"), (-1, "apple pie"), (0, "iphone now"), (5, "apple late"), (6, "apple too late"), (1, "other")]
    news = spark.createDataFrame(
        [(i, t, t0 + dt.timedelta(hours=h), "u", "s", "") for i, (h, t) in enumerate(hours)],
        "article_id long, title string, published_at timestamp, url string, source string, description string")
    windowed = TR.windows(events)
    pairs = TR.graded(TR.articles_in_window(windowed, news))
    v = TR.verdicts(windowed, pairs).head()
    assert (v["raw_results"], v["relevant_candidates"], v["before_or_at"], v["after"]) == (5, 4, 3, 1)
    assert (v["strength"], v["title"], v["query"]) == ("Strong", "apple camera", "Apple iPhone camera")


def test_metrics_zero_division(spark):
    p = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "d")], "true_label string, predicted_label string")
    m = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in EV.class_metrics(p).collect()}
    assert m["b"] == (0.0, 0.0, 0.0) and m["d"] == (0.0, 0.0, 0.0) and m["a"] == (0.5, 1.0, pytest.approx(2 / 3))


def test_quality_suite_counts_violations(spark):
    users = spark.createDataFrame([("1", "x", "en", dt.date(2024, 1, 1), 5), ("1", None, "en", None, -1)],
                                  "user_id string, location string, language string, account_created date, follower_count long")
    posts = spark.createDataFrame([("p", "9", "Reddit", "nan", "t", None, -1, 1, 1)], FI.POSTS_SCHEMA)
    got = {r["check"]: r["violations"] for r in Q.user_post_checks(users, posts).collect()}
    assert len(got) == 15
    assert got["users: user_id is unique"] == 1 and got["users: follower_count is not negative"] == 1
    assert got["posts: user_id exists"] == 1 and got["posts: no placeholder text"] == 1 and got["posts: likes is not negative"] == 1


def _stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_merge_survives_restarts(spark, tmp_path):
    from chirrup.streaming import posts as ST

    schema, source, out = "post_uri string, arrival int", f"{tmp_path}/in", f"{tmp_path}/out"
    for k, rows in enumerate(([("a", 1), ("b", 2)], [("b", 3), ("c", 4)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ST.start_merge(_stream_of(spark, source, schema), out, f"{tmp_path}/first").awaitTermination()
    spark.createDataFrame([("c", 9), ("d", 5)], schema).coalesce(1).write.mode("append").parquet(source)
    ST.start_merge(_stream_of(spark, source, schema), out, f"{tmp_path}/second").awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted((r.post_uri, r.arrival) for r in rows.collect()) == [("a", 1), ("b", 2), ("c", 4), ("d", 5)]
    replay = ST.merge_batch(out, "post_uri", "arrival", ST.run_name(f"{tmp_path}/first"))
    replay(spark.createDataFrame([("b", 3), ("c", 4)], schema), 1)
    assert spark.read.parquet(out).count() == 4


def test_stream_hours_keep_late_and_open_rows(spark, tmp_path):
    from chirrup.streaming import posts as ST

    schema, source, out = "ts timestamp, engagement long, sentiment_label string", f"{tmp_path}/in", f"{tmp_path}/out"
    for day, hour in ((9, 12), (1, 3), (9, 12)):  # the second file is eight days late
        at = dt.datetime(2024, 5, day, hour, 10, tzinfo=dt.timezone.utc)
        spark.createDataFrame([(at, 2, "Positive"), (at, 3, "Negative")], schema).coalesce(1).write.mode("append").parquet(source)
        ST.start_hourly(_stream_of(spark, source, schema), out, f"{tmp_path}/state").awaitTermination()
    got = sorted((r.post_count, r.total_engagement, r.n_negative, r.n_positive) for r in ST.read_hourly(spark, out).collect())
    assert got == [(2, 5, 1, 1), (4, 10, 2, 2)]


def test_digest_key_tells_nulls_from_texts(spark):
    rows = [("a", None, 1), ("a", None, 1), ("a", "null", 1), ("a,", "b", 2), ("a", ",b", 2)]
    df = spark.createDataFrame(rows, "x string, y string, n int")
    assert df.groupBy(*C.digest_key(df, df.columns)).count().count() == 4
    assert Q.repeated(df, df.columns).head()[0] == 1


def test_suites_with_repeats_hot_authors_and_few_scans(spark):
    users = spark.createDataFrame([(str(i % 50), "x", "en", dt.date(2024, 1, 10), 5) for i in range(51)],
                                  "user_id string, location string, language string, account_created date, follower_count long")
    rows = [(f"p{i}", "0" if i % 3 else str(i % 60), "Reddit", "t", "r", dt.datetime(2024, 1, 1 + i % 20), 1, 1, 1) for i in range(300)]
    rows += rows[:4] + [("p0", "1", "Reddit", "other", "r", dt.datetime(2024, 1, 15), 1, 1, 1), ("new", None, "X", None, None, None, None, None, None)]
    posts = spark.createDataFrame(rows, FI.POSTS_SCHEMA)
    got = {r["check"]: r["violations"] for r in Q.user_post_checks(users, posts, ("Reddit",), "2024-01-01 00:00:00", "2024-01-18 23:59:59").collect()}
    ids = [r[1] for r in rows]
    known = {str(i) for i in range(50)}
    assert got["users: user_id is unique"] == 1 and got["posts: no repeated rows"] == 4 and got["posts: post_id is unique"] == 5
    assert got["posts: user_id exists"] == sum(i not in known for i in ids)
    early = sum((2 if r[1] == "0" else 1) for r in rows if r[1] in known and r[5] is not None and r[5] < dt.datetime(2024, 1, 10))
    assert got["posts: not before the account was created"] == early  # the author listed twice is met twice
    assert got["posts: event_time is present"] == 1 and got["posts: platform is a known one"] == 1
    assert got["posts: event_time is in the campaign window"] == 1 + sum(r[5] is not None and r[5].day > 18 for r in rows)
    empty = Q.user_post_checks(users.limit(0), posts.limit(0)).collect()
    assert len(empty) == 15 and all(r["violations"] == 0 and r["passed"] for r in empty)


def test_ties_at_the_last_rank(spark):
    ranked = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3), ("b", 3), ("c", 1), ("c", 1), ("c", 1), ("c", 1)], "location string, location_rank long")
    assert {(r.location, r.n_rows, r.n_last) for r in E.location_ties(ranked).collect()} == {("b", 4, 2), ("c", 4, 0)}


def test_class_balance_of_scored_parts(spark):
    rows = [("val", c) for c in ("A", "B", "C") for _ in range(10)] + [("test", "A")] * 12 + [("test", "B")] * 9 + [("test", "C")] * 3
    scored = spark.createDataFrame([(p, c, c) for p, c in rows], "part string, true_label string, predicted_label string")
    got = {r["check"]: r["violations"] for r in Q.model_checks(scored, ("A", "B", "C"), balance_pp={"val": 6.0, "test": 7.0}).collect()}
    assert got["classes of val within 6 points"] == 0 and got["classes of test within 7 points"] == 2
