"""Collected posts: flatten search hits, merge runs, summarise a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.functions.cleaning import parse_instant

POST_JSON = """
uri string, indexedAt string,
likeCount bigint, repostCount bigint, replyCount bigint, quoteCount bigint,
record struct<text: string, createdAt: string>,
author struct<handle: string, did: string>
"""
COLLECTED = (
    "post_uri", "text", "created_at", "indexed_at", "collected_at", "author_handle", "author_did",
    "like_count", "repost_count", "reply_count", "quote_count", "permalink", "query_term",
)
PROFILE_URL = "https://bsky.app/profile/"  # fixed value: permalink prefix


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _counter(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast("bigint"))


def flatten_posts(hits: DataFrame) -> DataFrame:
    """`payload` JSON to flat columns; missing texts are empty, counters zero."""
    post = hits.withColumn("p", F.from_json("payload", POST_JSON))
    uri, handle = _text("p.uri"), _text("p.author.handle")
    tail = F.when(uri.contains("/"), F.element_at(F.split(uri, "/"), -1)).otherwise("")
    permalink = F.when(
        (handle != "") & (tail != ""), F.concat(F.lit(PROFILE_URL), handle, F.lit("/post/"), tail)
    ).otherwise("")
    carried = [c for c in hits.columns if c not in ("payload", "query_term", "collected_at")]
    return post.select(
        uri.alias("post_uri"),
        _text("p.record.text").alias("text"),
        _text("p.record.createdAt").alias("created_at"),
        _text("p.indexedAt").alias("indexed_at"),
        "collected_at",
        handle.alias("author_handle"),
        _text("p.author.did").alias("author_did"),
        _counter("p.likeCount").alias("like_count"),
        _counter("p.repostCount").alias("repost_count"),
        _counter("p.replyCount").alias("reply_count"),
        _counter("p.quoteCount").alias("quote_count"),
        permalink.alias("permalink"),
        "query_term",
        *carried,
    )


def merge_first_seen(existing: DataFrame, new: DataFrame, key: str = "post_uri", arrival: str = "arrival") -> DataFrame:
    """Stored rows win over new ones, earlier arrivals over later ones.

    The `row_number() = 1` filter becomes a group limit ahead of the shuffle:
    each task sends one row per key, so a post returned by very many queries
    does not pile up in one task. Rows without a key are dropped.
    """
    stored = existing.withColumn("is_new", F.lit(0))
    both = stored.unionByName(new.withColumn("is_new", F.lit(1)))
    first = Window.partitionBy(key).orderBy("is_new", arrival)
    return (
        both.filter(F.coalesce(F.col(key), F.lit("")) != "")
        .withColumn("seen", F.row_number().over(first))
        .filter(F.col("seen") == 1)
        .drop("seen")
    )


def run_summary(hits: DataFrame, merged: DataFrame, errors: int = 0) -> DataFrame:
    """One row per run: new and total posts, source time range, error count.

    Times are compared as instants, so offsets do not disturb the range.
    """
    created = parse_instant("created_at")
    totals = merged.agg(
        F.coalesce(F.sum(F.col("is_new").cast("bigint")), F.lit(0)).alias("new_posts"),
        F.count(F.lit(1)).alias("total_posts"),
        F.min(created).alias("source_min"),
        F.max(created).alias("source_max"),
    )
    n_hits = hits.agg(F.count(F.lit(1)).alias("n"))
    return totals.select(
        n_hits.scalar().alias("hits"), "new_posts", "total_posts", "source_min", "source_max",
        F.lit(errors).cast("bigint").alias("errors"),
    )


def hits_per_query(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_term").agg(F.count(F.lit(1)).alias("hits"))


def collection_checks(merged: DataFrame) -> DataFrame:
    """Rows with empty text and rows without a source time."""

    def blank(c: str) -> Column:
        return F.count_if(F.trim(F.coalesce(F.col(c), F.lit(""))) == "")

    wide = merged.agg(blank("text").alias("empty text"), blank("created_at").alias("missing created_at"))
    return wide.unpivot([], ["empty text", "missing created_at"], "check", "violations").withColumn(
        "passed", F.col("violations") == 0
    )
