"""Candidate explanations of events: interval join, grading, verdicts."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from chirrup.operators.ranking import small_side
from chirrup.params import TriggerParams

STRENGTHS = ("Strong", "Weak", "Unexplained")


def search_query(topic: Column, product: str) -> Column:
    """Product name, plus the top topic unless the name already holds it."""
    extra = (F.coalesce(topic, F.lit("")) != "") & ~F.lower(F.lit(product)).contains(F.lower(topic))
    return F.when(extra, F.concat_ws(" ", F.lit(product), topic)).otherwise(F.lit(product))


def windows(events: DataFrame, params: TriggerParams = TriggerParams()) -> DataFrame:
    """Search window and query per event (`timestamp`, `topic` given)."""
    before, after = f"interval {params.hours_before} hours", f"interval {params.hours_after} hours"
    return events.select(
        "event_id",
        "event_type",
        F.col("timestamp").alias("event_timestamp"),
        F.coalesce("topic", F.lit("")).alias("topic"),
        search_query(F.col("topic"), params.product).alias("query"),
        (F.col("timestamp") - F.expr(before)).alias("window_start"),
        (F.col("timestamp") + F.expr(after)).alias("window_end"),
    )


def articles_in_window(windowed: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles strictly inside each event's window.

    Events are repeated for the calendar days their window touches and joined
    to articles on the day; the exact bounds are checked on the pairs, so each
    pair shows up once. The event side is bucket-sized and checked before it is
    broadcast, which leaves the articles unshuffled on any skewed day.
    """
    days = F.sequence(F.to_date("window_start"), F.to_date("window_end"), F.expr("interval 1 day"))
    by_day = windowed.withColumn("day", F.explode_outer(days))
    dated = articles.withColumn("day", F.to_date("published_at"))
    inside = (F.col("published_at") > F.col("window_start")) & (F.col("published_at") < F.col("window_end"))
    return dated.join(small_side(by_day), "day").filter(inside).drop("day")


def graded(pairs: DataFrame, params: TriggerParams = TriggerParams()) -> DataFrame:
    """Relevance of the title and the strength class of each pair."""
    title = F.lower("title")
    relevant = reduce(or_, [title.contains(w) for w in params.required_words])
    on_topic = (F.col("topic") != "") & title.contains(F.lower("topic"))
    early = F.col("published_at") <= F.col("event_timestamp")
    strength = F.when(early & on_topic, "Strong").when(early, "Weak").otherwise("Unexplained")
    return pairs.withColumn("relevant", relevant).withColumn("early", early).withColumn("strength", strength)


def candidates(pairs: DataFrame) -> DataFrame:
    return pairs.filter("relevant").select(
        "event_id", "event_timestamp", "event_type", "query", "title", "source", "published_at", "url",
        "description", "window_start", "window_end", "strength", "article_id",
    )


def verdicts(windowed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts and the best article per event, in one aggregation.

    The best article is the oldest of the strongest class; articles published
    after the event explain nothing. `min_by` keeps one row per event and task.
    """
    relevant = F.col("relevant")
    usable = relevant & F.col("early")
    order = F.struct(
        F.when(F.col("strength") == "Strong", 0).otherwise(1).alias("class"), F.col("published_at"), F.col("article_id")
    )
    best = F.min_by(F.struct("strength", "title", "url", "published_at"), F.when(usable, order))
    summary = pairs.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("raw_results"),
        F.count_if(relevant).alias("relevant_candidates"),
        F.count_if(usable).alias("before_or_at"),
        F.count_if(relevant & ~F.col("early")).alias("after"),
        best.alias("best"),
    )
    joined = windowed.select("event_id", "event_type", "event_timestamp", "query").join(summary, "event_id", "left")
    counts = ("raw_results", "relevant_candidates", "before_or_at", "after")
    return joined.select(
        "event_id", "event_type", "event_timestamp", "query",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("best.strength", F.lit("Unexplained")).alias("strength"),
        F.col("best.title").alias("title"), F.col("best.url").alias("url"),
        F.col("best.published_at").alias("published_at"),
    )
