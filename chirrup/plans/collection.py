"""Queries on collected posts: flatten, merge, run log, relevance, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from chirrup.operators import clean as CL
from chirrup.plans import check_sql as S
from chirrup.plans.registry import Query
from chirrup.sources import collect as CO, roles
from chirrup.sources.roles import document_posts, raw_post_json, scored_posts, table
from chirrup.streaming import posts as ST

FLAT = ", ".join(CO.COLLECTED)


def flattened(spark, d):
    return CO.flatten_posts(raw_post_json(spark, d)).select(*CO.COLLECTED)


def _runs(spark, d):
    """Hits of an earlier run (its third of the posts) and of the new run."""
    hits = CO.flatten_posts(raw_post_json(spark, d))
    number = F.element_at(F.split("post_uri", "/"), -1).try_cast("bigint")
    earlier = hits.filter((F.col("query_term") == "technology") & (number % 3 == 0))
    return earlier.withColumn("query_term", F.lit("stored")), hits


def merged(spark, d):
    return CO.merge_first_seen(*_runs(spark, d)).select("post_uri", "query_term", "is_new", "arrival")


def run_log(spark, d):
    earlier, hits = _runs(spark, d)
    log = CO.run_summary(hits, CO.merge_first_seen(earlier, hits))
    return log.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c.startswith("source") else c for c in log.columns])


def hits_per_query(spark, d):
    return CO.hits_per_query(CO.flatten_posts(raw_post_json(spark, d)))


def collection_checks(spark, d):
    return CO.collection_checks(scored_posts(spark, d))


def relevance(spark, d):
    return CL.judge_relevance(document_posts(spark, d)).select("post_id", "query_term", "kept", "reason")


def relevance_counts(spark, d):
    return CL.relevance_counts(CL.judge_relevance(document_posts(spark, d)))


def exclusions(spark, d):
    return CL.exclusion_log(CL.judge_relevance(document_posts(spark, d)), "post_id")


def relevant(spark, d):
    kept = CL.relevant_posts(CL.judge_relevance(document_posts(spark, d)))
    return kept.select("post_id", F.md5("text").alias("text_md5"))


def enriched(spark, d):
    """Cleaned text, label fallback and future flag for every scored post."""
    posts = scored_posts(spark, d)
    # every seventh post has no prediction
    predicted = F.when(F.col("post_id") % 7 != 0, F.col("sentiment_label")).otherwise("")
    return CL.enrich(posts, predicted).select("post_id", F.md5("clean_text").alias("text_md5"), "sentiment_label", "future_dated_anomaly")


# ------------------------------------------------------------------ streams
def _event_stream(spark, d):
    e = ST.read_posts(spark, d, "events")
    k, hour = F.col("event_id"), F.expr("interval 1 hour")
    return e.select(
        k.alias("post_id"), "ts",
        F.when(k % 50 == 0, F.col("ts") - hour).otherwise(F.col("ts") + hour).alias("collected"),
        roles._sentiment_of(F.col("event_type")).alias("sentiment_label"),
        F.floor("value").alias("engagement"),
    )


def stream_timeline(spark, d):
    ordinary, _ = ST.split_future(_event_stream(spark, d))
    out = ST.run_hourly(ordinary, "timeline")
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


def stream_timeline_full(spark, d):
    ordinary, _ = ST.split_future(_event_stream(spark, d))
    out = ST.run_timeline(ordinary, "timeline")
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


def stream_future(spark, d):
    _, future = ST.split_future(_event_stream(spark, d))
    return ST.run_to_table(future.select("post_id", "sentiment_label"), "future")


def _twice(stream):
    """Every fortieth post arrives a second time."""
    copies = F.when(F.col("post_id") % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = stream.withColumn("again", F.explode_outer(copies))
    return again.select(
        F.concat(F.lit("post/"), F.col("post_id").cast("string")).alias("post_uri"), "ts", "sentiment_label",
        (F.col("post_id") + F.col("again")).alias("arrival"),
    )


def stream_merge(spark, d):
    out = ST.run_merge(_twice(_event_stream(spark, d)).drop("ts"), "merge")
    return out.select("post_uri", "sentiment_label", "arrival")


def stream_dedup(spark, d):
    unique = ST.first_ever(_twice(_event_stream(spark, d)), "post_uri")
    return ST.run_to_table(unique.select("post_uri", "sentiment_label"), "dedup")


_SENT = S.SENTIMENT
_REASON = """CASE WHEN query_term IN ('apple iphone', 'iphone') THEN 'product ' WHEN query_term = 'technology' THEN 'generic '
             ELSE 'unknown ' END || 'query=' || query_term || CASE WHEN kept THEN ', keyword found' ELSE ', no keyword' END"""
_JUDGED = S.with_views("doc_posts", judged=f"SELECT *, {S.product('text')} AS kept FROM doc_posts")
_RUNS = S.with_views("hits", runs="""
    SELECT post_uri, 'stored' AS query_term, 0 AS is_new, arrival, created FROM hits WHERE post_uri <> '' AND q = 1 AND k % 3 = 0
    UNION ALL SELECT post_uri, query_term, 1, arrival, created FROM hits WHERE post_uri <> ''""",
    merged="SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY post_uri ORDER BY is_new, arrival) = 1")

QUERIES: dict[str, Query] = {
    "flatten_json": Query(flattened, f"{S.with_views('hits')} SELECT {FLAT} FROM hits"),
    "merge_posts": Query(merged, f"{_RUNS} SELECT post_uri, query_term, is_new, arrival FROM merged"),
    "run_log": Query(run_log, f"""{_RUNS} SELECT (SELECT count(*) FROM hits) AS hits, CAST(sum(is_new) AS BIGINT) AS new_posts,
        count(*) AS total_posts, strftime(min(created), '%Y-%m-%d %H:%M:%S') AS source_min,
        strftime(max(created), '%Y-%m-%d %H:%M:%S') AS source_max, CAST(0 AS BIGINT) AS errors FROM merged"""),
    "hits_per_query": Query(hits_per_query, f"{S.with_views('hits')} SELECT query_term, count(*) AS hits FROM hits GROUP BY 1"),
    "collection_checks": Query(collection_checks, f"""{S.with_views('scored')}
        SELECT 'empty text' AS "check", v AS violations, v = 0 AS passed FROM (SELECT count(*) FILTER (WHERE trim(text) = '') AS v FROM scored)
        UNION ALL SELECT 'missing created_at', v, v = 0 FROM (SELECT count(*) FILTER (WHERE created IS NULL) AS v FROM scored)"""),
    "relevance_split": Query(relevance, f"{_JUDGED} SELECT post_id, query_term, kept, {_REASON} AS reason FROM judged"),
    "relevance_counts": Query(relevance_counts, f"{_JUDGED} SELECT query_term, kept, count(*) AS posts FROM judged GROUP BY ALL"),
    "exclusion_log": Query(exclusions, f"""{_JUDGED} SELECT post_id, query_term, {_REASON} AS reason, substring(text, 1, 120) AS text_preview
        FROM judged WHERE NOT kept"""),
    "relevant_posts": Query(relevant, f"{_JUDGED} SELECT post_id, md5(text) AS text_md5 FROM judged WHERE kept"),
    "enriched_posts": Query(enriched, f"""{S.with_views('scored')}
        SELECT post_id, md5({S.clean_text('text')}) AS text_md5, CASE WHEN post_id % 7 = 0 THEN 'Neutral' ELSE label END AS sentiment_label,
               coalesce(created > collected, false) AS future_dated_anomaly FROM scored"""),
    "stream_timeline": Query(stream_timeline, f"""
        WITH e AS (SELECT *, {_SENT} AS label FROM events WHERE event_id % 50 <> 0)
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS post_count,
               CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total_engagement,
               count(*) FILTER (WHERE label = 'Negative') AS n_negative, count(*) FILTER (WHERE label = 'Positive') AS n_positive
        FROM e GROUP BY date_trunc('hour', ts)"""),
    "stream_timeline_full": Query(stream_timeline_full, f"""
        WITH e AS (SELECT date_trunc('hour', ts) AS hour, CAST(floor(value) AS BIGINT) AS eng, {_SENT} AS label FROM events WHERE event_id % 50 <> 0),
        h AS (SELECT hour, count(*) AS n, sum(eng) AS total, count(*) FILTER (WHERE label = 'Negative') AS a,
                     count(*) FILTER (WHERE label = 'Positive') AS c FROM e GROUP BY 1),
        every AS (SELECT unnest(generate_series((SELECT min(hour) FROM h), (SELECT max(hour) FROM h), INTERVAL 1 HOUR)) AS hour)
        SELECT strftime(every.hour, '%Y-%m-%d %H:%M:%S') AS hour, coalesce(n, 0) AS post_count, CAST(coalesce(total, 0) AS BIGINT) AS total_engagement,
               coalesce(round_even(total / n, 2), 0.0) AS avg_engagement, coalesce(round_even(a / n * 100, 2), 0.0) AS pct_negative,
               coalesce(round_even((n - a - c) / n * 100, 2), 0.0) AS pct_neutral, coalesce(round_even(c / n * 100, 2), 0.0) AS pct_positive
        FROM every LEFT JOIN h ON h.hour = every.hour"""),
    "stream_future_rows": Query(stream_future, f"SELECT event_id AS post_id, {_SENT} AS sentiment_label FROM events WHERE event_id % 50 = 0"),
    "stream_merge_posts": Query(stream_merge, f"SELECT 'post/' || event_id AS post_uri, {_SENT} AS sentiment_label, event_id AS arrival FROM events"),
    "stream_dedup": Query(stream_dedup, f"SELECT 'post/' || event_id AS post_uri, {_SENT} AS sentiment_label FROM events"),
}
