"""Queries on texts: cleaning, quality, lengths, tokens, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.functions import text as X
from chirrup.operators import engagement as E, profile as PR, ranking as R, topics as TP
from chirrup.plans import check_sql as S
from chirrup.plans.registry import Query
from chirrup.sources.roles import fan_out, labelled_texts, table, texts


def labelled(spark, d):
    return labelled_texts(spark, d).withColumn("text_clean", X.clean_text("post_text"))


def documents(spark, d):
    return fan_out(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def clean_texts(spark, d):
    cleaned = texts(spark, d).withColumn("text_clean", X.clean_text("text"))
    return cleaned.select("text_id", "kind", F.md5("text_clean").alias("text_md5"), F.length("text_clean").cast("bigint").alias("chars"))


def changed(spark, d):
    return PR.changed_by_cleaning(texts(spark, d).withColumn("text_clean", X.clean_text("text")), "text", "text_clean")


def lengths(spark, d):
    t = texts(spark, d)
    return PR.length_stats(t, "text", ["kind"]).unionByName(PR.length_stats(t, "text").withColumn("kind", F.lit("all")))


def length_histogram(spark, d):
    t = texts(spark, d).select("kind", X.word_count("text").alias("words"))
    return E.histogram(t, "words", 25, ["kind"])


def markers(spark, d):
    t = texts(spark, d)
    return t.select(
        "text_id",
        X.has_negation("text").alias("negation"),
        X.has_sarcasm("text").alias("sarcasm"),
        F.size(X.hashtags("text")).cast("bigint").alias("hashtags"),
        X.pattern_count("text", X.MENTION).alias("mentions"),
        X.word_count("text").alias("words"),
        F.col("text").rlike(f"(?U){X.URL}").alias("has_url"),
    )


def tfidf(spark, d):
    w = TP.tfidf(documents(spark, d), "doc_id", "text")
    return w.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


def escapes(spark, d):
    """Document texts with escapes put in front, decoded again."""
    t = documents(spark, d).select("doc_id", F.concat(F.lit("\\u2019\\u00e9 \\ud83d\\ude00 a\\b "), F.col("text")).alias("t"))
    return t.select("doc_id", F.md5(X.decode_escapes("t")).alias("text_md5"))


_ISSUES = {
    "unicode_escape": S.hit("text", r"\\u[0-9A-Fa-f]{4}"),
    "html_entity": S.hit("text", "(?i)&(?:amp|quot|#39|lt|gt);"),
    "at_user": S.hit("text", r"(?i)@user\b"),
    "at_other": "len(list_filter(regexp_extract_all(text, '@([A-Za-z0-9_]+)', 1), lambda m: m <> 'user')) > 0",
    "url": S.hit("text", r"https?://\S+|www\.\S+"),
    "hashtag": S.hit("text", "#[A-Za-z0-9_]+"),
}
_LENGTHS = """count(*) AS n, min(c) AS chars_min, max(c) AS chars_max, round(avg(c), 2) AS chars_mean, median(c) AS chars_median,
    round(stddev_samp(c), 2) AS chars_std, min(w) AS words_min, max(w) AS words_max, round(avg(w), 2) AS words_mean,
    median(w) AS words_median, round(stddev_samp(w), 2) AS words_std"""
_SIZED = S.with_views("all_texts", sized=f"SELECT kind, length(text) AS c, len({S.words('text')}) AS w FROM all_texts")
_LABELLED = S.with_views("labelled", lab=f"SELECT *, {S.clean_text('post_text')} AS text_clean FROM labelled")
_STOPS = S.listing((*S.STOP_WORDS, *P.SOCIAL_STOP_WORDS))


def word_terms(source: str, key: str, text: str) -> dict[str, str]:
    """Views for word (1,2)-gram counts of a source."""
    return {
        "tk": f"SELECT {key}, {S.word_tokens(text)} AS k FROM {source}",
        "tf": f"SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(list_concat(k, {S.bigrams('k')})) AS term FROM tk) GROUP BY ALL",
        "voc": f"""SELECT term, ln((1 + (SELECT count(*) FROM {source})) / (1 + df)) + 1 AS idf FROM (
                   SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term) WHERE df >= 2 ORDER BY total DESC, term LIMIT 50000""",
        "wt": f"""SELECT {key}, term, tf, (1 + ln(tf)) * idf AS w, sqrt(sum(((1 + ln(tf)) * idf) ** 2) OVER (PARTITION BY {key})) AS norm
                  FROM tf JOIN voc USING (term)""",
    }


QUERIES: dict[str, Query] = {
    "clean_text_docs": Query(clean_texts, f"""{S.with_views('all_texts', c=f"SELECT text_id, kind, {S.clean_text('text')} AS t FROM all_texts")}
        SELECT text_id, kind, md5(t) AS text_md5, length(t) AS chars FROM c"""),
    "decode_escapes": Query(escapes, "SELECT doc_id, md5('’é 😀 a\\b ' || text) AS text_md5 FROM documents"),
    "changed_by_cleaning": Query(changed, f"""{S.with_views('all_texts')}
        SELECT count(*) FILTER (WHERE text <> {S.clean_text('text')}) AS changed, count(*) FILTER (WHERE text = {S.clean_text('text')}) AS unchanged FROM all_texts"""),
    "text_quality": Query(
        lambda s, d: PR.text_quality(texts(s, d), "text"),
        f"{S.with_views('all_texts')} " + " UNION ALL ".join(
            f"SELECT '{n}' AS issue, count(*) FILTER (WHERE {c}) AS n_rows, round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 1) AS pct FROM all_texts"
            for n, c in _ISSUES.items())),
    "text_lengths": Query(lengths, f"{_SIZED} SELECT kind, {_LENGTHS} FROM sized GROUP BY kind UNION ALL SELECT 'all', {_LENGTHS} FROM sized"),
    "length_histogram": Query(length_histogram, f"""{_SIZED}, b AS (SELECT kind, CAST(min(w) AS DOUBLE) AS lo, CAST(max(w) AS DOUBLE) AS hi FROM sized GROUP BY kind)
        SELECT kind, CAST(least(floor((w - lo) / (hi - lo) * 25), 24) AS BIGINT) AS bin, count(*) AS n FROM sized JOIN b USING (kind) GROUP BY ALL"""),
    "text_markers": Query(markers, f"""{S.with_views('all_texts')} SELECT text_id, {S.negation('text')} AS negation, {S.sarcasm('text')} AS sarcasm,
        len(regexp_extract_all(text, '#([\\p{{L}}\\p{{N}}_]+)', 1)) AS hashtags, len(regexp_extract_all(text, '@[A-Za-z0-9_]+')) AS mentions,
        len({S.words('text')}) AS words, {_ISSUES['url']} AS has_url FROM all_texts"""),
    "feature_rates": Query(
        lambda s, d: PR.feature_rates(labelled(s, d), "text_clean", "sentiment_label"), f"""{_LABELLED}, f AS (
        SELECT sentiment_label, len(regexp_extract_all(text_clean, '@user')) AS m, len(regexp_extract_all(text_clean, '#[A-Za-z0-9_]+')) AS h FROM lab)
        SELECT sentiment_label, count(*) AS n, round(100.0 * avg(CASE WHEN m > 0 THEN 1 ELSE 0 END), 1) AS pct_has_mention, round(avg(m), 2) AS mean_mentions,
               round(100.0 * avg(CASE WHEN h > 0 THEN 1 ELSE 0 END), 1) AS pct_has_hashtag, round(avg(h), 2) AS mean_hashtags FROM f GROUP BY 1"""),
    "label_shares": Query(
        lambda s, d: E.class_shares(labelled_texts(s, d), "sentiment_label"), f"""{S.with_views('labelled')}
        SELECT sentiment_label AS label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM labelled), 1) AS pct FROM labelled GROUP BY 1"""),
    "label_consistency": Query(
        lambda s, d: PR.label_consistency(labelled(s, d), "text_clean", ["sentiment_label", "topic_category"]), f"""{_LABELLED}, g AS (
        SELECT count(*) AS n, count(DISTINCT sentiment_label) AS a, count(DISTINCT topic_category) AS b FROM lab GROUP BY text_clean)
        SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups, count(*) FILTER (WHERE a > 1) AS mixed_sentiment_label,
               count(*) FILTER (WHERE b > 1) AS mixed_topic_category FROM g WHERE n > 1"""),
    "duplicate_texts": Query(
        lambda s, d: PR.duplicate_profile(texts(s, d), {"text_id": ["text_id"], "text": ["text"]}), f"{S.with_views('all_texts')} " + " UNION ALL ".join(
            f"""SELECT '{c}' AS key_name, CAST(sum(n - 1) AS BIGINT) AS extra_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_groups,
            count(*) FILTER (WHERE n > 1) AS groups FROM (SELECT count(*) AS n FROM all_texts GROUP BY {c})""" for c in ("text_id", "text"))),
    "class_sample": Query(
        lambda s, d: R.seeded_sample_per_group(labelled_texts(s, d).select("sentiment_label", "text_id"), "sentiment_label", "text_id", 10),
        f"""{S.with_views('labelled')} SELECT sentiment_label, text_id, row_number() OVER (PARTITION BY sentiment_label ORDER BY md5('42:' || text_id), text_id) AS position
        FROM labelled QUALIFY position <= 10"""),
    "top_tokens_by_class": Query(
        lambda s, d: TP.top_tokens(labelled(s, d), "text_clean", ["sentiment_label"]), f"""{_LABELLED}, t AS (
        SELECT sentiment_label, unnest(list_filter({S.social_tokens('text_clean')}, lambda w: w NOT IN ({_STOPS}))) AS term FROM lab)
        SELECT sentiment_label, term, count(*) AS n, row_number() OVER (PARTITION BY sentiment_label ORDER BY count(*) DESC, term) AS rank
        FROM t GROUP BY sentiment_label, term QUALIFY rank <= 20"""),
    "top_bigrams": Query(
        lambda s, d: TP.top_bigrams(documents(s, d), "text"), f"""WITH t AS (SELECT {S.social_tokens('text')} AS k FROM documents),
        b AS (SELECT unnest({S.bigrams('k')}) AS term FROM t) SELECT term, count(*) AS n FROM b GROUP BY term ORDER BY n DESC, term LIMIT 20"""),
    "vocab_by_min_df": Query(
        lambda s, d: TP.vocabulary_sizes(documents(s, d), "doc_id", "text"), f"""WITH t AS (SELECT doc_id, unnest(list_distinct({S.social_tokens('text')})) AS term FROM documents),
        f AS (SELECT term, count(*) AS df FROM t GROUP BY term), k AS (SELECT unnest([1, 2, 3, 5, 10]) AS k)
        SELECT CAST(k AS BIGINT) AS min_df, count(*) FILTER (WHERE df >= k) AS vocabulary FROM f, k GROUP BY k"""),
    "char_ngram_top": Query(
        lambda s, d: TP.top_char_ngrams(documents(s, d), "text"), f"""WITH w AS (SELECT ' ' || word || ' ' AS w, count(*) AS n FROM (
        SELECT unnest({S.words('lower(text)')}) AS word FROM documents) GROUP BY 1),
        g AS (SELECT substring(w, i, m) AS term, n FROM w, (SELECT unnest([3, 4, 5]) AS m) z, range(1, length(w) - m + 2) r(i))
        SELECT term, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY term ORDER BY n DESC, term LIMIT 50"""),
    "tfidf_weights": Query(tfidf, f"""WITH {", ".join(f"{n} AS ({q})" for n, q in word_terms('documents', 'doc_id', 'text').items())}
        SELECT doc_id, term, tf, round(w / norm, 6) AS weight FROM wt"""),
}
