"""Queries on timelines, events, topics and triggers."""

from __future__ import annotations

from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.operators import profile as PR, timeline as TL, topics as TP, triggers as TR
from chirrup.plans import check_sql as S
from chirrup.plans.registry import Query
from chirrup.session import cut_lineage
from chirrup.sources.roles import articles, document_posts, scored_posts

LOOSE = P.EventParams(shift_pp=200.0, shift_floor_pp=40.0, spike_std=12.0, spike_floor_std=1.5)


def _at(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _texts(df, *cols):
    return df.select(*[_at(c) if c in cols else F.col(c) for c in df.columns])


def _rounded(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def timeline(spark, d):
    return _texts(TL.hourly_timeline(scored_posts(spark, d)), "hour")


def timeline_by_user(spark, d):
    return _texts(TL.hourly_timeline(scored_posts(spark, d), ["user_id"]), "hour")


def source_range(spark, d):
    return _texts(TL.source_range(scored_posts(spark, d)), "first_ts", "last_ts")


def _events(spark, d, params=P.EventParams()):
    return TL.detect_events(TL.hourly_timeline(scored_posts(spark, d)), params)


def _shown(events):
    out = _texts(events, "timestamp", "previous_timestamp")
    return _rounded(out, 6, "metric_value", "delta_or_zscore", "threshold", "polarity")


def flagged(spark, d):
    return _shown(_events(spark, d))


def fallback(spark, d):
    return _shown(_events(spark, d, LOOSE))


def shifts(spark, d):
    return _shown(_events(spark, d)).filter("event_type = 'sentiment_shift'").drop("event_id")


def spikes(spark, d):
    return _shown(_events(spark, d)).filter("event_type = 'engagement_spike'").drop("event_id")


def events_by_user(spark, d):
    t = TL.hourly_timeline(scored_posts(spark, d), ["user_id"])
    return TL.detect_events(t, series=["user_id"]).groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


def summary(spark, d):
    s = TL.detection_summary(TL.hourly_timeline(scored_posts(spark, d)))
    return _rounded(s, 6, *[c for c in s.columns if not c.startswith("num")])


# ------------------------------------------------------- topics, entities
def _doc_events(spark, d):
    posts = document_posts(spark, d)
    return posts, cut_lineage(TL.detect_events(TL.hourly_timeline(posts)))


def topics(spark, d):
    events = cut_lineage(_events(spark, d))
    return TP.topics_by_event(scored_posts(spark, d), events)


def document_topics(spark, d):
    return TP.topics_by_event(*_doc_events(spark, d))


def entities(spark, d):
    return TP.entities_by_event(*_doc_events(spark, d))


def context(spark, d):
    posts, events = scored_posts(spark, d), cut_lineage(_events(spark, d))
    top, named = TP.topics_by_event(posts, events), TP.entities_by_event(posts, events)
    return _texts(TP.event_context(events, posts, top, named), "timestamp")


def with_entities(spark, d):
    posts, events = scored_posts(spark, d), cut_lineage(_events(spark, d))
    top, named = TP.topics_by_event(posts, events), TP.entities_by_event(posts, events)
    return TP.events_with_entities(TP.event_context(events, posts, top, named))


# ---------------------------------------------------------------- triggers
def _searched(spark, d):
    """Events with their first topic, the search windows and the graded pairs."""
    posts, events = scored_posts(spark, d), cut_lineage(_events(spark, d))
    first = TP.topics_by_event(posts, events).filter("role = 'current' AND rank = 1")
    topical = events.join(first.select("event_id", F.col("term").alias("topic")), "event_id", "left")
    windowed = cut_lineage(TR.windows(topical))
    return windowed, TR.graded(TR.articles_in_window(windowed, articles(spark, d)))


def windows(spark, d):
    return _texts(_searched(spark, d)[0], "event_timestamp", "window_start", "window_end")


def trigger_candidates(spark, d):
    c = TR.candidates(_searched(spark, d)[1])
    shown = _texts(c, "event_timestamp", "window_start", "window_end")
    return shown.select("event_id", "event_type", "query", "title", "url", "strength", "window_start", "window_end", "article_id",
                        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


def trigger_verdicts(spark, d):
    return _texts(TR.verdicts(*_searched(spark, d)), "event_timestamp", "published_at")


# ------------------------------------------------------------------ checks
_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _pct(part, whole="post_count"):
    return f"CASE WHEN {whole} = 0 OR {whole} IS NULL THEN 0.0 ELSE round_even({part} / {whole} * 100, 2) END"


def _timeline_views(source):
    return {
        "ok": f"SELECT *, date_trunc('hour', created) AS h FROM {source} WHERE created IS NOT NULL AND collected IS NOT NULL",
        "agg": """SELECT h, count(*) AS post_count, CAST(sum(engagement) AS BIGINT) AS total_engagement,
                  count(*) FILTER (WHERE label = 'Negative') AS neg, count(*) FILTER (WHERE label = 'Positive') AS pos FROM ok GROUP BY h""",
        "spine": "SELECT unnest(generate_series((SELECT min(h) FROM agg), (SELECT max(h) FROM agg), INTERVAL 1 HOUR)) AS h",
        "tl": f"""SELECT spine.h AS hour, coalesce(post_count, 0) AS post_count, coalesce(total_engagement, 0) AS total_engagement,
                  CASE WHEN post_count > 0 THEN round_even(total_engagement / post_count, 2) ELSE 0.0 END AS avg_engagement,
                  {_pct('neg')} AS pct_negative, {_pct('(post_count - neg - pos)')} AS pct_neutral, {_pct('pos')} AS pct_positive
                  FROM spine LEFT JOIN agg ON spine.h = agg.h""",
    }


def _event_views(p=P.EventParams()):
    return {
        "st": "SELECT avg(total_engagement) AS m, stddev_samp(total_engagement) AS s FROM tl",
        "pol": "SELECT *, pct_positive - pct_negative AS polarity FROM tl",
        "pair": """SELECT a.*, b.hour AS prev_hour, a.polarity - b.polarity AS delta,
                   a.post_count > 0 AND b.post_count > 0 AS filled
                   FROM pol a LEFT JOIN pol b ON b.hour = a.hour - INTERVAL 1 HOUR""",
        "lim": f"""SELECT m, s,
                   CASE WHEN EXISTS (SELECT 1 FROM pair WHERE filled AND abs(delta) >= {p.shift_pp}) THEN {p.shift_pp} ELSE {p.shift_floor_pp} END AS sl,
                   CASE WHEN EXISTS (SELECT 1 FROM pair WHERE total_engagement >= m + {p.spike_std} * s) THEN m + {p.spike_std} * s
                        ELSE m + {p.spike_floor_std} * s END AS pl FROM st""",
        "found": """SELECT hour, 0 AS o, 'sentiment_shift' AS event_type, polarity AS metric_value, delta AS delta_or_zscore, CAST(sl AS DOUBLE) AS threshold,
                    prev_hour, post_count, pct_negative, pct_neutral, pct_positive, polarity FROM pair, lim WHERE filled AND abs(delta) >= sl
                    UNION ALL
                    SELECT hour, 1, 'engagement_spike', total_engagement, round_even((total_engagement - m) / s, 4), round_even(pl, 4),
                    prev_hour, post_count, pct_negative, pct_neutral, pct_positive, polarity FROM pair, lim WHERE total_engagement >= pl""",
        "ev": "SELECT printf('EVT_%03d', row_number() OVER (ORDER BY hour, o)) AS event_id, * FROM found",
    }


_EVENT_OUT = f"""strftime(hour, {_STAMP}) AS "timestamp", event_type, round(metric_value, 6) AS metric_value,
    round(delta_or_zscore, 6) AS delta_or_zscore, round(threshold, 6) AS threshold, '1 hour' AS bucket_size,
    strftime(prev_hour, {_STAMP}) AS previous_timestamp, post_count, pct_negative, pct_neutral, pct_positive, round(polarity, 6) AS polarity"""
_TL = S.with_views("scored", **_timeline_views("scored"))
_EV = S.with_views("scored", **_timeline_views("scored"), **_event_views())

_BY_USER = {
    "ok": "SELECT *, date_trunc('hour', created) AS h FROM scored WHERE created IS NOT NULL AND collected IS NOT NULL",
    "agg": """SELECT user_id, h, count(*) AS post_count, CAST(sum(engagement) AS BIGINT) AS total_engagement,
              count(*) FILTER (WHERE label = 'Negative') AS neg, count(*) FILTER (WHERE label = 'Positive') AS pos FROM ok GROUP BY ALL""",
    "spine": "SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM (SELECT user_id, min(h) AS lo, max(h) AS hi FROM agg GROUP BY 1)",
    "tl": f"""SELECT user_id, h AS hour, coalesce(post_count, 0) AS post_count, coalesce(total_engagement, 0) AS total_engagement,
              CASE WHEN post_count > 0 THEN round_even(total_engagement / post_count, 2) ELSE 0.0 END AS avg_engagement,
              {_pct('neg')} AS pct_negative, {_pct('(post_count - neg - pos)')} AS pct_neutral, {_pct('pos')} AS pct_positive
              FROM spine LEFT JOIN agg USING (user_id, h)""",
}
_USER_EVENTS = {
    "x": """SELECT *, pct_positive - pct_negative AS polarity, avg(total_engagement) OVER w AS m, coalesce(stddev_samp(total_engagement) OVER w, 0) AS s
            FROM tl WINDOW w AS (PARTITION BY user_id)""",
    "y": """SELECT a.*, abs(a.polarity - b.polarity) AS delta, coalesce(a.post_count > 0 AND b.post_count > 0, false) AS filled
            FROM x a LEFT JOIN x b ON a.user_id = b.user_id AND b.hour = a.hour - INTERVAL 1 HOUR""",
    "z": """SELECT *, CASE WHEN bool_or(filled AND delta >= 15) OVER w THEN 15 ELSE 10 END AS sl,
            CASE WHEN bool_or(total_engagement >= m + 2 * s) OVER w THEN m + 2 * s ELSE m + s END AS pl FROM y WINDOW w AS (PARTITION BY user_id)""",
    "f": """SELECT user_id, hour, 0 AS o, 'sentiment_shift' AS event_type FROM z WHERE filled AND delta >= sl
            UNION ALL SELECT user_id, hour, 1, 'engagement_spike' FROM z WHERE total_engagement >= pl""",
    "ids": "SELECT *, printf('EVT_%03d', row_number() OVER (PARTITION BY user_id ORDER BY hour, o)) AS event_id FROM f",
}


def _topic_views(source):
    stops = S.listing(S.STOP_WORDS)
    return {
        "eh": """SELECT event_id, 'current' AS role, hour AS h FROM ev UNION ALL
                 SELECT event_id, 'previous', prev_hour FROM ev WHERE prev_hour IS NOT NULL""",
        "cleaned": f"SELECT post_id, date_trunc('hour', created) AS h, {S.topic_text(S.clean_text('text'))} AS t FROM {source} WHERE created IS NOT NULL",
        "toks": f"""SELECT post_id, h, list_filter(regexp_extract_all(t, '[a-z][a-z0-9'']{{2,}}'), lambda w: w NOT IN ({stops})) AS k
                    FROM cleaned WHERE length(t) > 10""",
        "placed": f"SELECT event_id, role, post_id, list_concat(k, {S.bigrams('k')}) AS terms FROM toks JOIN eh USING (h)",
        "n": "SELECT event_id, role, count(*) AS n FROM placed GROUP BY ALL",
        "tf": "SELECT event_id, role, post_id, term, count(*) AS tf FROM (SELECT event_id, role, post_id, unnest(terms) AS term FROM placed) GROUP BY ALL",
        "voc": """SELECT event_id, role, term, ln((1 + n) / (1 + df)) + 1 AS idf FROM (
                  SELECT event_id, role, term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY ALL) JOIN n USING (event_id, role)
                  QUALIFY row_number() OVER (PARTITION BY event_id, role ORDER BY total DESC, term) <= 150""",
        "wt": """SELECT event_id, role, post_id, term, tf * idf AS w, sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY event_id, role, post_id)) AS norm
                 FROM tf JOIN voc USING (event_id, role, term)""",
        "sc": "SELECT event_id, role, term, round(sum(w / norm), 6) AS score FROM wt GROUP BY ALL",
        "top": "SELECT *, row_number() OVER (PARTITION BY event_id, role ORDER BY score DESC, term) AS rank FROM sc QUALIFY rank <= 5",
    }


def _entity_views(source):
    flags = ", ".join(f"CASE WHEN {S.entity('text', n)} THEN {S.quote(n)} END" for n in P.ENTITY_NAMES)
    return {
        "named": f"""SELECT date_trunc('hour', created) AS h, unnest(list_filter([{flags}], lambda x: x IS NOT NULL)) AS entity
                     FROM {source} WHERE created IS NOT NULL""",
        "ents": """SELECT event_id, role, entity, count(*) AS n, row_number() OVER (PARTITION BY event_id, role ORDER BY count(*) DESC, entity) AS rank
                   FROM named JOIN eh USING (h) GROUP BY event_id, role, entity QUALIFY rank <= 10""",
    }


_DOC_EV = {**_timeline_views("doc_posts"), **_event_views()}
_TOPICS = S.with_views("scored", **_timeline_views("scored"), **_event_views(), **_topic_views("scored"))
_CONTEXT = S.with_views(
    "scored", **_timeline_views("scored"), **_event_views(), **_topic_views("scored"), **_entity_views("scored"),
    tt="SELECT event_id, role, string_agg(term, ', ' ORDER BY rank) AS s FROM top GROUP BY ALL",
    et="SELECT event_id, role, string_agg(entity || ' (' || n || ')', ', ' ORDER BY rank) AS s FROM ents GROUP BY ALL",
    bc="SELECT date_trunc('hour', created) AS hour, count(*) AS c FROM scored WHERE created IS NOT NULL GROUP BY 1",
    cx=f"""SELECT event_id, strftime(hour, {_STAMP}) AS "timestamp", event_type, coalesce(c, 0) AS bucket_post_count,
           coalesce((SELECT s FROM tt WHERE tt.event_id = ev.event_id AND role = 'current'), '') AS current_topics,
           coalesce((SELECT s FROM tt WHERE tt.event_id = ev.event_id AND role = 'previous'), '') AS previous_topics,
           coalesce((SELECT s FROM et WHERE et.event_id = ev.event_id AND role = 'current'), '') AS current_entities,
           coalesce((SELECT s FROM et WHERE et.event_id = ev.event_id AND role = 'previous'), '') AS previous_entities
           FROM ev LEFT JOIN bc USING (hour)""")
_TRIGGER = S.with_views(
    "scored", "news", **_timeline_views("scored"), **_event_views(), **_topic_views("scored"),
    win="""SELECT event_id, event_type, hour, coalesce(term, '') AS topic,
           CASE WHEN coalesce(term, '') <> '' AND NOT contains('apple iphone', lower(term)) THEN 'Apple iPhone ' || term ELSE 'Apple iPhone' END AS query,
           hour - INTERVAL 24 HOUR AS ws, hour + INTERVAL 6 HOUR AS we
           FROM ev LEFT JOIN (SELECT event_id, term FROM top WHERE role = 'current' AND rank = 1) USING (event_id)""",
    pairs="""SELECT *, contains(lower(title), 'iphone') OR contains(lower(title), 'apple') AS relevant, published_at <= hour AS early,
             CASE WHEN published_at <= hour AND topic <> '' AND contains(lower(title), topic) THEN 'Strong'
                  WHEN published_at <= hour THEN 'Weak' ELSE 'Unexplained' END AS strength
             FROM win JOIN news ON published_at > ws AND published_at < we""",
    best="""SELECT * FROM pairs WHERE relevant AND early QUALIFY row_number() OVER (PARTITION BY event_id
            ORDER BY CASE strength WHEN 'Strong' THEN 0 ELSE 1 END, published_at, article_id) = 1""",
    cnt="""SELECT event_id, count(*) AS raw_results, count(*) FILTER (WHERE relevant) AS relevant_candidates,
           count(*) FILTER (WHERE relevant AND early) AS before_or_at, count(*) FILTER (WHERE relevant AND NOT early) AS "after" FROM pairs GROUP BY 1""")

QUERIES: dict[str, Query] = {
    "hourly_timeline": Query(timeline, f"{_TL} SELECT * REPLACE (strftime(hour, {_STAMP}) AS hour) FROM tl"),
    "hourly_timeline_by_user": Query(timeline_by_user, f"{S.with_views('scored', **_BY_USER)} SELECT * REPLACE (strftime(hour, {_STAMP}) AS hour) FROM tl"),
    "source_range": Query(source_range, f"""{S.with_views('scored')} SELECT strftime(min(created), {_STAMP}) AS first_ts,
        strftime(max(created), {_STAMP}) AS last_ts, count(*) FILTER (WHERE created > collected) AS future_dated FROM scored WHERE created IS NOT NULL"""),
    "flagged_events": Query(flagged, f"{_EV} SELECT event_id, {_EVENT_OUT} FROM ev"),
    "event_fallback": Query(fallback, f"{S.with_views('scored', **_timeline_views('scored'), **_event_views(LOOSE))} SELECT event_id, {_EVENT_OUT} FROM ev"),
    "sentiment_shifts": Query(shifts, f"{_EV} SELECT {_EVENT_OUT} FROM ev WHERE o = 0"),
    "engagement_spikes": Query(spikes, f"{_EV} SELECT {_EVENT_OUT} FROM ev WHERE o = 1"),
    "events_by_user": Query(events_by_user, f"""{S.with_views('scored', **_BY_USER, **_USER_EVENTS)}
        SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_id FROM ids GROUP BY ALL"""),
    "detection_summary": Query(summary, f"""{_EV} SELECT CAST(max(sl) AS DOUBLE) AS shift_threshold, round(max(pl), 6) AS spike_threshold,
        round(max(m), 6) AS mean_engagement, round(max(s), 6) AS std_engagement,
        (SELECT round(avg(post_count), 6) FROM tl) AS mean_post_count, (SELECT round(stddev_samp(post_count), 6) FROM tl) AS std_post_count,
        (SELECT count(*) FROM found WHERE o = 0) AS num_shifts, (SELECT count(*) FROM found WHERE o = 1) AS num_spikes FROM lim"""),
    "topics_by_event": Query(topics, f"{_TOPICS} SELECT event_id, role, term, score, rank FROM top"),
    "topics_by_event_documents": Query(document_topics, f"""{S.with_views('doc_posts', **_DOC_EV, **_topic_views('doc_posts'))}
        SELECT event_id, role, term, score, rank FROM top"""),
    "entities_by_event": Query(entities, f"""{S.with_views('doc_posts', **_DOC_EV, **_topic_views('doc_posts'), **_entity_views('doc_posts'))}
        SELECT event_id, role, entity, n, rank FROM ents"""),
    "event_context": Query(context, f"{_CONTEXT} SELECT * FROM cx"),
    "events_with_entities": Query(with_entities, f"{_CONTEXT} SELECT count(*) AS events, count(*) FILTER (WHERE current_entities <> '' OR previous_entities <> '') AS with_entities FROM cx"),
    "trigger_windows": Query(windows, f"""{_TRIGGER} SELECT event_id, event_type, strftime(hour, {_STAMP}) AS event_timestamp, topic, query,
        strftime(ws, {_STAMP}) AS window_start, strftime(we, {_STAMP}) AS window_end FROM win"""),
    "trigger_candidates": Query(trigger_candidates, f"""{_TRIGGER} SELECT event_id, event_type, query, title, url, strength, strftime(ws, {_STAMP}) AS window_start,
        strftime(we, {_STAMP}) AS window_end, article_id, strftime(published_at, {_STAMP}) AS published_at FROM pairs WHERE relevant"""),
    "trigger_verdicts": Query(trigger_verdicts, f"""{_TRIGGER} SELECT event_id, win.event_type, strftime(win.hour, {_STAMP}) AS event_timestamp, win.query,
        coalesce(raw_results, 0) AS raw_results, coalesce(relevant_candidates, 0) AS relevant_candidates, coalesce(before_or_at, 0) AS before_or_at,
        coalesce("after", 0) AS "after", coalesce(strength, 'Unexplained') AS strength, title, url, strftime(published_at, {_STAMP}) AS published_at
        FROM win LEFT JOIN cnt USING (event_id) LEFT JOIN best USING (event_id)"""),
}
