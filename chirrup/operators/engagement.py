"""Engagement statistics over users and posts."""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C, text as X
from chirrup.functions.arrays import one_row_each
from chirrup.operators.ranking import top_per_group


def by_platform(posts: DataFrame) -> DataFrame:
    total = C.engagement_total()
    return (
        posts.filter(F.col("platform").isNotNull())
        .groupBy("platform")
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.avg("likes").alias("avg_likes"),
            F.avg("shares").alias("avg_shares"),
            F.avg("comments").alias("avg_comments"),
            F.avg(total).alias("avg_total_engagement"),
        )
        .orderBy(F.desc("avg_total_engagement"), "platform")
    )


def user_totals(posts: DataFrame) -> DataFrame:
    """Post count and engagement per author, before any user join.

    Aggregating on the posts side first means an author holding a third of all
    posts is combined map-side instead of being one skewed join key.
    """
    return posts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("post_count"), F.sum(C.engagement_total()).alias("total_engagement")
    )


def author_totals(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Per user with posts: location, followers, post count, engagement."""
    return user_totals(posts).join(users.select("user_id", "location", "follower_count"), "user_id")


def by_location(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts, total and mean engagement per author location."""
    grouped = author_totals(users, posts).groupBy("location").agg(
        F.sum("post_count").alias("post_count"), F.sum("total_engagement").alias("total_engagement")
    )
    mean = F.round(F.col("total_engagement") / F.col("post_count"), 1)
    return grouped.withColumn("avg_engagement_per_post", mean).orderBy(F.desc("total_engagement"), "location")


def top_users_by_location(users: DataFrame, posts: DataFrame, n: int = 3) -> DataFrame:
    """Users ranked in their location by engagement; ties at rank `n` stay."""
    ranked = top_per_group(
        author_totals(users, posts), ["location"], [F.desc("total_engagement")], n, "location_rank", ties=True
    )
    return ranked.select(
        "location", "location_rank", "user_id", "follower_count", "post_count", "total_engagement"
    ).orderBy("location", "location_rank", "user_id")


def top_user_per_location(users: DataFrame, posts: DataFrame) -> DataFrame:
    order = [F.desc("total_engagement"), F.col("user_id")]
    return top_per_group(author_totals(users, posts), ["location"], order, 1).select(
        "location", "user_id", "total_engagement"
    )


def location_ties(ranked: DataFrame, n: int = 3) -> DataFrame:
    """Locations with more than one user at the last rank or over `n` rows."""
    return (
        ranked.groupBy("location")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("location_rank") == n).alias("n_last"))
        .filter((F.col("n_rows") > n) | (F.col("n_last") > 1))
    )


def class_shares(df: DataFrame, label: str, as_name: str = "label") -> DataFrame:
    """Rows per value and their share; the total is over the tiny result."""
    counts = df.groupBy(F.col(label).alias(as_name)).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


# ------------------------------------------------------------- distributions
def _per_followers(users: DataFrame, posts: DataFrame, *sums: Column) -> DataFrame:
    """Sums per `follower_count` over the posts of known users.

    Posts are summed per author before they meet the users, so a hot author is
    combined map-side, and then per follower count.
    """
    names = [f"s{i}" for i in range(len(sums))]
    per_user = posts.groupBy("user_id").agg(*[s.cast("double").alias(n) for s, n in zip(sums, names, strict=True)])
    known = users.select("user_id", "follower_count").filter(F.col("follower_count").isNotNull())
    return per_user.join(known, "user_id").groupBy("follower_count").agg(*[F.sum(n).alias(n) for n in names])


def _corr(x: Column, n: str, y: str, yy: str) -> Column:
    """Pearson correlation of x with y from the number, sum and sum of squares of y per value of x."""
    rows, sy = F.sum(n), F.sum(y)
    sx, sxx = F.sum(x * F.col(n)), F.sum(x * x * F.col(n))
    spread = F.sqrt((rows * sxx - sx * sx) * (rows * F.sum(yy) - sy * sy))
    return (rows * F.sum(x * F.col(y)) - sx * sy) / F.nullif(spread, F.lit(0.0))


def follower_correlation(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Pearson correlation of followers with engagement and with likes."""
    engagement = C.engagement_known("likes", "shares", "comments").cast("double")
    likes = F.col("likes").cast("double")
    sums = [f(v) for v in (engagement, likes) for f in (F.count, F.sum, lambda v: F.sum(v * v))]
    grouped = _per_followers(users, posts, *sums)
    x = F.col("follower_count").cast("double")
    return grouped.agg(_corr(x, "s0", "s1", "s2").alias("corr_engagement"), _corr(x, "s3", "s4", "s5").alias("corr_likes"))


def follower_deciles(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Follower cuts at 0.1 and 0.9 over post rows, mean engagement beyond.

    The cuts are exact: rows are counted per follower count, and cumulative
    counts give the ranks. The counts are added up in slices of the value range,
    so no task sees more than one slice or the list of slices.
    """
    engagement = C.engagement_known("likes", "shares", "comments")
    grouped = _per_followers(users, posts, F.count(F.lit(1)), F.sum(engagement), F.count(engagement))
    values = grouped.select(F.col("follower_count").alias("v"), F.col("s0").alias("n"), F.coalesce("s1", F.lit(0.0)).alias("total"), F.col("s2").alias("rated"))
    ladder = _weighted_ranks(values)
    ends = []
    for p, name in ((0.1, "low"), (0.9, "high")):
        spot = p * (F.col("rows") - 1)
        below, above = (F.min(F.when(F.col("upto") > f(spot), F.col("v"))) for f in (F.floor, F.ceil))
        part = F.max(spot - F.floor(spot))
        ends.append((below + (above - below) * part).cast("double").alias(name))
    cuts = ladder.agg(F.struct(*ends).alias("cuts")).scalar()

    def mean(side: Column) -> Column:
        return F.sum(F.when(side, F.col("total"))) / F.nullif(F.sum(F.when(side, F.col("rated"))), F.lit(0.0))

    means = values.agg(mean(F.col("v") >= cuts["high"]).alias("top_mean"), mean(F.col("v") <= cuts["low"]).alias("bottom_mean"))
    gap = F.abs(F.col("top_mean") - F.col("bottom_mean")) / F.nullif(F.col("bottom_mean"), F.lit(0.0)) * 100
    return means.select(cuts["high"].alias("top_cut"), cuts["low"].alias("bottom_cut"), "top_mean", "bottom_mean", gap.alias("gap_pct"))


SLICE_BITS = 12  # follower counts that share all but these low bits are ranked in one task


def _weighted_ranks(values: DataFrame) -> DataFrame:
    """values(v, n) with `upto`, the rows at or below v, and `rows`, all rows."""
    sliced = values.withColumn("slice", F.shiftright("v", SLICE_BITS))
    sizes = sliced.groupBy("slice").agg(F.sum("n").alias("size"))
    before = Window.partitionBy().orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("slice", F.coalesce(F.sum("size").over(before), F.lit(0.0)).alias("offset"), F.sum("size").over(Window.partitionBy()).alias("rows"))
    inside = Window.partitionBy("slice").orderBy("v")
    return sliced.withColumn("upto", F.sum("n").over(inside)).join(offsets, "slice").withColumn("upto", F.col("upto") + F.col("offset"))


def platform_spread(posts: DataFrame) -> DataFrame:
    """(highest − lowest) / lowest mean engagement over platforms, in percent."""
    means = (
        posts.filter(F.col("platform").isNotNull())
        .groupBy("platform")
        .agg(F.avg(C.engagement_known("likes", "shares", "comments")).alias("mean"))
    )
    low, high = F.min("mean"), F.max("mean")
    return means.agg(low.alias("lowest"), high.alias("highest"), ((high - low) / F.nullif(low, F.lit(0.0)) * 100).alias("spread_pct"))


def histogram(df: DataFrame, column: str, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between minimum and maximum; last bin closed right.

    Without groups the two bounds are a one-row subquery over the same column;
    each group has a range of its own.
    """
    v = F.col(column).cast("double")
    known = df.select(*groups, v.alias("v")).filter(F.col("v").isNotNull())
    bounds = F.struct(F.min("v").alias("low"), F.max("v").alias("high"))
    if groups:
        ranges = known.groupBy(*[F.col(g).alias(f"_{g}") for g in groups]).agg(bounds.alias("_bounds"))
        same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups])
        known, bounds = known.join(ranges, same), F.col("_bounds")
    else:
        bounds = known.agg(bounds).scalar()
    width = bounds["high"] - bounds["low"]
    spot = F.when(width > 0, F.floor((F.col("v") - bounds["low"]) / width * bins)).otherwise(0)
    return known.groupBy(*groups, F.least(spot, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def monthly_volume(posts: DataFrame) -> DataFrame:
    """Posts per calendar month from first to last, empty months as zero.

    Gaps are filled from each month to the next one present, on the monthly
    counts (a table no longer than the calendar).
    """
    months = (
        posts.filter(F.col("event_time").isNotNull())
        .groupBy(F.to_date(F.trunc(F.col("event_time").cast("date"), "month")).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    following = F.lead("month").over(Window.partitionBy().orderBy("month"))
    last_filled = F.coalesce(F.add_months(following, -1), F.col("month"))
    spread = months.withColumn("last_filled", last_filled)
    filled = spread.select(
        F.explode_outer(F.sequence("month", "last_filled", F.expr("interval 1 month"))).alias("at"), "month", "n"
    )
    return filled.select(
        F.col("at").alias("month"), F.when(F.col("at") == F.col("month"), F.col("n")).otherwise(0).alias("posts")
    )


# ------------------------------------------------------------- data issues
def negative_likes_rate(raw: DataFrame, by: Column, name: str) -> DataFrame:
    """Share of present likes below zero per slice."""
    likes = C.to_long_or_null("likes")
    return (
        raw.select(by.alias(name), likes.alias("n_likes"))
        .filter(F.col("n_likes").isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("n_likes") < 0).cast("double")).alias("negative_rate"))
    )


def raw_month(column: str = "timestamp") -> Column:
    return F.date_format(C.parse_timestamp(column), "yyyy-MM")


def platform_or_missing(column: str = "platform") -> Column:
    return F.coalesce(C.normalize_missing(column), F.lit("Missing"))


def duplicate_rate_by_month(raw: DataFrame) -> DataFrame:
    """Share of rows that have a full-row twin, per month of the raw time.

    Copies are counted by grouping on all columns (combined map-side) rather
    than with a window that would gather every copy in one task.
    """
    copies = raw.withColumn("_month", raw_month()).groupBy("_month", *C.digest_key(raw, raw.columns)).agg(F.count(F.lit(1)).alias("copies"))
    twin_rows = F.sum(F.when(F.col("copies") > 1, F.col("copies")).otherwise(0))
    return copies.groupBy(F.col("_month").alias("month")).agg(
        F.sum("copies").alias("n"), (twin_rows / F.sum("copies")).alias("duplicate_rate")
    )


def phrase_contingency(posts: DataFrame, text: str = "text_content") -> DataFrame:
    """Posts with positive cues, negative cues, both or neither, with shares."""
    cues = posts.filter(F.col(text).isNotNull()).select(
        X.has_any_phrase(text, P.POSITIVE_PHRASES).alias("pos"),
        X.has_any_phrase(text, P.NEGATIVE_PHRASES).alias("neg"),
    )
    pos, neg = F.col("pos"), F.col("neg")
    kind = (
        F.when(pos & neg, "both").when(pos, "positive only").when(neg, "negative only").otherwise("neither")
    )
    return class_shares(cues.select(kind.alias("cue")), "cue", "cue")


def completeness(posts: DataFrame) -> DataFrame:
    """How often likes are present, with and without a platform tag."""
    return posts.groupBy(F.col("platform").isNotNull().alias("has_platform")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("likes").isNotNull().cast("double")).alias("likes_present_rate")
    )


def hashtag_counts(posts: DataFrame, text: str = "text_content", n: int = 15) -> DataFrame:
    """Most used hashtags with their count per text that is present."""
    known = posts.filter(F.col(text).isNotNull())
    texts = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    tags = one_row_each(known, [], X.hashtags(text), "tag")
    counts = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "tag").limit(n)
    return top.withColumn("pct_of_texts", F.round(100.0 * F.col("n") / texts, 1))
