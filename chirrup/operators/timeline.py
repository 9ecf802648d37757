"""Hourly timelines without gaps, and events found on them.

Everything after the first aggregation works on bucket tables, whose size is
bounded by the calendar (hours per series) and not by the number of posts. That
bound is what makes the per-series windows below safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.functions import cleaning as C
from chirrup.params import EventParams

ONE_HOUR = "interval 1 hour"
COUNTERS = ("like_count", "repost_count", "reply_count", "quote_count")


def timed_posts(posts: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Posts with both times readable: instant, label, engagement, future flag."""
    created, collected = C.parse_instant("created_at"), C.parse_instant("collected_at")
    return posts.select(
        *series,
        created.alias("ts"),
        "sentiment_label",
        C.engagement_counters(*COUNTERS).alias("engagement"),
        C.is_future_dated(created, collected).alias("future"),
        collected.alias("collected"),
    ).dropna(subset=["ts", "collected"])


def hour_counts(timed: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Posts, engagement and label counts per hour that has posts."""
    label = F.col("sentiment_label")
    negative, positive = F.count_if(label == "Negative"), F.count_if(label == "Positive")
    return timed.groupBy(*series, F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("engagement").alias("total_engagement"),
        negative.alias("n_negative"),
        positive.alias("n_positive"),
        (F.count(F.lit(1)) - negative - positive).alias("n_neutral"),
    )


def fill_hours(counts: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Every hour from the first to the last of a series, absent ones as zero.

    Each row is repeated up to the next hour present; the repeats are zeroed.
    This needs one window over the bucket table and no calendar join.
    """
    following = F.lead("hour").over(Window.partitionBy(*series).orderBy("hour"))
    until = F.coalesce(following - F.expr(ONE_HOUR), F.col("hour"))
    hours = F.sequence(F.col("hour"), F.col("until"), F.expr(ONE_HOUR))
    spread = counts.withColumn("until", until).withColumn("at", F.explode_outer(hours))
    values = [c for c in counts.columns if c not in (*series, "hour")]
    real = F.col("at") == F.col("hour")
    return spread.select(
        *series, F.col("at").alias("hour"), *[F.when(real, F.col(c)).otherwise(0).alias(c) for c in values]
    )


def _share(part: Column, whole: Column) -> Column:
    """Percentage rounded half to even; zero for an empty bucket."""
    return F.coalesce(F.bround(F.try_divide(part, whole) * 100, 2), F.lit(0.0))


def hourly_timeline(posts: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return timeline_measures(fill_hours(hour_counts(timed_posts(posts, series), series), series), series)


def timeline_measures(filled: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Average engagement and label percentages of hour counts."""
    n = F.col("post_count")
    mean = F.coalesce(F.bround(F.try_divide("total_engagement", n), 2), F.lit(0.0))
    return filled.select(
        *series,
        "hour",
        "post_count",
        "total_engagement",
        mean.alias("avg_engagement"),
        _share(F.col("n_negative"), n).alias("pct_negative"),
        _share(F.col("n_neutral"), n).alias("pct_neutral"),
        _share(F.col("n_positive"), n).alias("pct_positive"),
    )


def source_range(posts: DataFrame) -> DataFrame:
    """First and last source instant, and the number of future-dated posts."""
    return timed_posts(posts).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_if("future").alias("future_dated")
    )


# ------------------------------------------------------------------- events
def bucket_statistics(timeline: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Timeline with polarity, previous bucket, mean, std and z-score."""
    whole = Window.partitionBy(*series)
    ordered = whole.orderBy("hour")
    std = F.coalesce(F.stddev_samp("total_engagement").over(whole), F.lit(0.0))
    return (
        timeline.withColumn("polarity", F.col("pct_positive") - F.col("pct_negative"))
        .withColumn("mean_engagement", F.avg("total_engagement").over(whole))
        .withColumn("std_engagement", std)
        .withColumn("previous_hour", F.lag("hour").over(ordered))
        .withColumn("delta", F.col("polarity") - F.lag("polarity").over(ordered))
        .withColumn("previous_count", F.lag("post_count").over(ordered))
        .withColumn(
            "z",
            F.coalesce(F.try_divide(F.col("total_engagement") - F.col("mean_engagement"), "std_engagement"), F.lit(0.0)),
        )
    )


def flagged_buckets(timeline: DataFrame, params: EventParams = EventParams(), series: Sequence[str] = ()) -> DataFrame:
    """Shift and spike flags at the strict level, or at the floor if none passed.

    Both levels are computed in the same pass; whether any bucket passed the
    strict one is a window maximum over the bucket table.
    """
    b = bucket_statistics(timeline, series)
    whole = Window.partitionBy(*series)
    mean, std = F.col("mean_engagement"), F.col("std_engagement")
    both_filled = (F.col("post_count") >= params.min_bucket_posts) & (F.col("previous_count") >= params.min_bucket_posts)
    strict_spike, floor_spike = mean + params.spike_std * std, mean + params.spike_floor_std * std
    swing = F.abs("delta")

    def passes(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    b = b.withColumn("strict_shift", passes(both_filled & (swing >= params.shift_pp))).withColumn(
        "strict_spike", passes(F.col("total_engagement") >= strict_spike)
    )
    b = b.withColumn(
        "shift_threshold",
        F.when(F.max("strict_shift").over(whole), params.shift_pp).otherwise(params.shift_floor_pp),
    ).withColumn("spike_threshold", F.when(F.max("strict_spike").over(whole), strict_spike).otherwise(floor_spike))
    return b.withColumn("is_shift", passes(both_filled & (swing >= F.col("shift_threshold")))).withColumn(
        "is_spike", F.col("total_engagement") >= F.col("spike_threshold")
    )


def detect_events(timeline: DataFrame, params: EventParams = EventParams(), series: Sequence[str] = ()) -> DataFrame:
    """Sentiment shifts and engagement spikes with ids in time order.

    A bucket can be both; at equal times the shift comes first.
    """
    shift = F.when(
        F.col("is_shift"),
        F.struct(
            F.lit("sentiment_shift").alias("event_type"),
            F.col("polarity").alias("metric_value"),
            F.col("delta").alias("delta_or_zscore"),
            F.col("shift_threshold").alias("threshold"),
        ),
    )
    spike = F.when(
        F.col("is_spike"),
        F.struct(
            F.lit("engagement_spike").alias("event_type"),
            F.col("total_engagement").cast("double").alias("metric_value"),
            F.bround("z", 4).alias("delta_or_zscore"),
            F.bround("spike_threshold", 4).alias("threshold"),
        ),
    )
    b = flagged_buckets(timeline, params, series).filter("is_shift OR is_spike")
    found = b.withColumn("found", F.explode_outer(F.array_compact(F.array(shift, spike))))
    in_order = Window.partitionBy(*series).orderBy("hour", F.desc("found.event_type"))
    return found.select(
        *series,
        F.format_string("EVT_%03d", F.row_number().over(in_order)).alias("event_id"),
        F.col("hour").alias("timestamp"),
        "found.*",
        F.lit(params.bucket_label).alias("bucket_size"),
        F.col("previous_hour").alias("previous_timestamp"),
        "post_count", "pct_negative", "pct_neutral", "pct_positive", "polarity",
    )


def detection_summary(timeline: DataFrame, params: EventParams = EventParams()) -> DataFrame:
    """The thresholds used and the statistics behind them, as one row."""
    b = flagged_buckets(timeline, params)
    return b.agg(
        F.max("shift_threshold").alias("shift_threshold"),
        F.max("spike_threshold").alias("spike_threshold"),
        F.avg("total_engagement").alias("mean_engagement"),
        F.coalesce(F.stddev_samp("total_engagement"), F.lit(0.0)).alias("std_engagement"),
        F.avg("post_count").alias("mean_post_count"),
        F.coalesce(F.stddev_samp("post_count"), F.lit(0.0)).alias("std_post_count"),
        F.count_if("is_shift").alias("num_shifts"),
        F.count_if("is_spike").alias("num_spikes"),
    )
