"""Table cleaning: users, posts, orphans, relevance, scoring columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C, text as X
from chirrup.sources.files import CLEAN_POSTS


def clean_users(raw: DataFrame) -> DataFrame:
    """Trim, type and de-duplicate users; a bad follower count fails the job."""
    return raw.select(
        C.strip("user_id").alias("user_id"),
        C.strip("location").alias("location"),
        C.strip("language").alias("language"),
        F.to_date(C.strip("account_created")).alias("account_created"),
        C.to_long_strict("follower_count").alias("follower_count"),
    ).dropDuplicates()


def typed_posts(raw: DataFrame) -> DataFrame:
    """Raw text posts to typed posts, one row out per row in.

    Missing fields stay null, likes lose a flipped sign, the raw time is kept.
    Placeholders are resolved in a step of their own, so the expressions built
    on the text do not repeat it.
    """
    known = raw.withColumn("text_content", C.normalize_missing("text_content"))
    return known.select(
        "post_id",
        "user_id",
        C.normalize_missing("platform").alias("platform"),
        X.restore_text("text_content").alias("text_content"),
        F.col("timestamp").alias("timestamp_raw"),
        C.parse_timestamp("timestamp").alias("event_time"),
        F.abs(C.to_long_or_null("likes")).alias("likes"),
        C.to_long_strict("shares").alias("shares"),
        C.to_long_strict("comments").alias("comments"),
    ).select(*CLEAN_POSTS)


def clean_posts(raw: DataFrame) -> DataFrame:
    """Typed posts without full-row copies.

    Rows are compared after normalisation, raw time text included. Copies
    collapse in the map-side aggregate, so a row repeated very often costs one
    row per task in the shuffle.
    """
    return typed_posts(raw).dropDuplicates()


def in_time_order(posts: DataFrame) -> DataFrame:
    """Range-partitioned sort for report output; ties by post id."""
    return posts.orderBy("event_time", "post_id")


def orphans(posts: DataFrame, users: DataFrame) -> DataFrame:
    return posts.join(users.select("user_id"), "user_id", "left_anti")


def with_known_user(posts: DataFrame, users: DataFrame) -> DataFrame:
    return posts.join(users.select("user_id"), "user_id", "left_semi")


# ------------------------------------------------------------------ relevance
def judge_relevance(posts: DataFrame) -> DataFrame:
    """Add `kept` and `reason`; both are never null, so the halves add up."""
    term = F.lower(C.strip(F.coalesce("query_term", F.lit(""))))
    hit = X.mentions_product(F.coalesce("text", F.lit("")))
    query = F.concat(F.lit("query="), term)
    reason = (
        F.when(term.isin(*P.PRODUCT_QUERIES), F.concat(F.lit("product "), query))
        .when(term == P.GENERIC_QUERY, F.concat(F.lit("generic "), query))
        .otherwise(F.concat(F.lit("unknown "), query))
    )
    outcome = F.when(hit, ", keyword found").otherwise(", no keyword")
    return posts.withColumn("kept", hit).withColumn("reason", F.concat(reason, outcome))


def relevant_posts(judged: DataFrame) -> DataFrame:
    return judged.filter("kept").drop("kept", "reason")


def exclusion_log(judged: DataFrame, key: str = "post_uri") -> DataFrame:
    """Excluded posts with the reason and a short text preview (log only)."""
    return judged.filter(~F.col("kept")).select(
        key, "query_term", "reason", F.substring("text", 1, 120).alias("text_preview")
    )


def relevance_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("query_term", "kept").agg(F.count(F.lit(1)).alias("posts"))


# ------------------------------------------------------------------ labels
def encode_labels(df: DataFrame, codes: dict[str, int], label: str, name: str) -> DataFrame:
    """Label ids from the fixed map; an unknown label fails the job."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    code = F.create_map(*pairs)[F.col(label)].cast("bigint")
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(label), F.lit("null"))))
    return df.withColumn(name, F.coalesce(code, unknown.cast("bigint")))


def unknown_labels(df: DataFrame, label: str, known: DataFrame) -> DataFrame:
    """Labels present in the data but not in the label table."""
    return df.select(F.col(label).alias("label")).distinct().subtract(known.select("label"))


def flag_future(posts: DataFrame) -> DataFrame:
    created, collected = C.parse_instant("created_at"), C.parse_instant("collected_at")
    return posts.withColumn("future_dated_anomaly", C.is_future_dated(created, collected))


def enrich(posts: DataFrame, predicted: Column) -> DataFrame:
    """Cleaned text, label with fallback and future flag beside each post."""
    labelled = posts.withColumn("clean_text", X.clean_text(F.coalesce("text", F.lit(""))))
    return flag_future(labelled.withColumn("sentiment_label", C.label_or_fallback(predicted)))
