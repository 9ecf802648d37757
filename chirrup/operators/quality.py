"""Data-quality suites: a check is a named count of violations.

A suite reduces each table once to what its checks need (condition bits, key
digests) and writes that. Conditions are sums over one grouped pass, all keys are
counted in one tagged union, and a foreign key is one join of rows counted before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chirrup import params as P
from chirrup.functions import text as X
from chirrup.functions.cleaning import digest_key
from chirrup.operators.evaluation import PRED, TRUE
from chirrup.session import written


def run_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows (check, violations, passed) for conditions that must not hold."""
    counted = [
        F.struct(F.lit(name).alias("check"), F.count_if(F.coalesce(bad, F.lit(False))).alias("violations"))
        for name, bad in checks.items()
    ]
    return _verdict(df.agg(F.array(*counted).alias("c")).select(F.inline("c")))


def count_check(df: DataFrame, name: str) -> DataFrame:
    """A check whose violations are the rows of `df`."""
    return _verdict(df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations"))


def _verdict(rows: DataFrame) -> DataFrame:
    return rows.withColumn("passed", F.col("violations") == 0)


def all_of(*suites: DataFrame) -> DataFrame:
    out = suites[0]
    for s in suites[1:]:
        out = out.unionByName(s)
    return out


def repeated(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per copy beyond the first of each key."""
    counts = df.groupBy(*digest_key(df, cols)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))


def repeat_check(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    return _verdict(repeated(df, cols).select(F.lit(name).alias("check"), "violations"))


def user_post_checks(
    users: DataFrame, posts: DataFrame, platforms: Sequence[str] = P.PLATFORMS,
    start: str = P.WINDOW_START, end: str = P.WINDOW_END,
) -> DataFrame:
    """The fifteen checks on cleaned users and posts."""

    def in_placeholders(c: str) -> Column:
        return F.lower(c).isin("nan", "null", "none", "")

    cells = sum((F.col(c).isNull().cast("int") for c in users.columns), F.lit(0))
    on_users = {
        "users: no missing values": cells > 0,
        "users: follower_count is not negative": F.col("follower_count") < 0,
        "users: account_created is a date": F.col("account_created").isNull(),
    }
    when = F.col("event_time")
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    on_posts = {
        "posts: likes is not negative": F.col("likes") < 0,
        "posts: shares is present and not negative": F.col("shares").isNull() | (F.col("shares") < 0),
        "posts: comments is present and not negative": F.col("comments").isNull() | (F.col("comments") < 0),
        "posts: event_time is present": when.isNull(),
        "posts: platform is a known one": ~F.col("platform").isin(*platforms),
        "posts: no placeholder text": in_placeholders("platform") | in_placeholders("text_content"),
        "posts: event_time is in the campaign window": when.isNull() | (when < first) | (when > last),
    }
    # both tables once, without texts: key, condition bits, digests of what must be unique
    slim_users = written(users.select("user_id", "account_created", _bits(on_users), _digests(users, {"users: user_id is unique": ["user_id"]})), "check-users")
    slim_posts = written(posts.select("user_id", when.cast("date").alias("day"), _bits(on_posts), _digests(
        posts, {"posts: no repeated rows": posts.columns, "posts: post_id is unique": ["post_id"]})), "check-posts")

    keys = slim_users.select(F.explode("keys").alias("k")).unionByName(slim_posts.select(F.explode("keys").alias("k")))
    copies = keys.groupBy("k.name", "k.digest").agg(F.count(F.lit(1)).alias("n")).groupBy("name").agg(F.sum(F.col("n") - 1).alias("violations"))
    # posts per author and day: an account's first day is a date, so a day is early as a whole
    days = slim_posts.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"), *_sums(on_posts))
    authors = slim_users.select("user_id", "account_created", F.lit(True).alias("known"))
    joined = days.join(authors, "user_id", "left")
    early = F.sum(F.when(F.col("day") < F.col("account_created"), F.col("n")))
    links = joined.agg(F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("posts: user_id exists"), early.alias("posts: not before the account was created"))
    rows = [slim_users.agg(*_sums(on_users)), days.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in on_posts]), links]
    counted = copies.select(F.col("name").alias("check"), "violations")
    for r in rows:
        counted = counted.unionByName(r.unpivot([], [F.col(f"`{c}`") for c in r.columns], "check", "violations"))
    names = ["users: user_id is unique", *on_users, "posts: no repeated rows", "posts: post_id is unique", "posts: user_id exists", *on_posts,
             "posts: not before the account was created"]
    every = users.sparkSession.createDataFrame([(n,) for n in names], "check string")
    return _verdict(every.join(F.broadcast(counted), "check", "left").select("check", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")))


def _bits(checks: Mapping[str, Column]) -> Column:
    """The conditions that hold for a row, one bit each."""
    return sum((F.when(F.coalesce(bad, F.lit(False)), F.lit(1 << i)).otherwise(0) for i, bad in enumerate(checks.values())), F.lit(0)).alias("bits")


def _sums(checks: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(F.col("bits").bitwiseAND(1 << i) != 0).alias(name) for i, name in enumerate(checks)]


def _digests(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> Column:
    """An entry (name, digest) for each key that must be unique."""
    def digest(cols: Sequence[str]) -> Column:
        return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"}), 256))

    return F.array(*[F.struct(F.lit(name).alias("name"), digest(cols).alias("digest")) for name, cols in keys.items()]).alias("keys")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """Keys on which two independent results differ or that one side lacks."""
    l = left.select(*keys, F.col(value).alias("left_value"))
    r = right.select(*keys, F.col(value).alias("right_value"))
    gap = F.abs(F.col("left_value") - F.col("right_value"))
    both = l.join(r, list(keys), "full_outer")
    return both.filter(F.col("left_value").isNull() | F.col("right_value").isNull() | (gap > tolerance))


def rank_order_breaks(ranked: DataFrame, group: str, rank: str, value: str) -> DataFrame:
    """Rows whose value exceeds the value of the row ranked before them.

    Applied to top-k results, whose groups are small by construction.
    """
    from pyspark.sql import Window

    before = F.lag(value).over(Window.partitionBy(group).orderBy(rank, F.desc(value)))
    return ranked.withColumn("_before", before).filter(F.col(value) > F.col("_before")).drop("_before")


def expect(df: DataFrame, name: str, actual: Column, holds: Column) -> DataFrame:
    """A one-row expectation on an aggregate."""
    one = df.agg(actual.alias("_a"), holds.alias("_h"))
    return one.select(
        F.lit(name).alias("check"), F.when(F.col("_h"), 0).otherwise(1).cast("bigint").alias("violations")
    ).withColumn("passed", F.col("violations") == 0)


def result_checks(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Fifteen checks on the three standing results.

    Each result is compared with a second computation along another path: the
    results aggregate posts per user before joining, the twins join row by row.
    """
    from chirrup.functions.cleaning import engagement_total
    from chirrup.operators import engagement as E

    # the second path: every post meets its user first, and all twins come from one grouped table
    rated = posts.select("user_id", "platform", engagement_total().alias("engagement"))
    merged = rated.join(users.select("user_id", "location"), "user_id", "left")
    twin = written(merged.groupBy("platform", "location", "user_id").agg(
        F.count(F.lit(1)).alias("posts"), F.count("engagement").alias("rated"), F.sum("engagement").alias("total_engagement")), "twin")
    tagged, located = F.col("platform").isNotNull(), F.col("location").isNotNull()

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("posts"))), F.lit(0))

    facts = twin.agg(rows(F.lit(True)).alias("posts"), rows(~tagged).alias("untagged"), rows(tagged).alias("tagged"), rows(located).alias("located"),
                     F.count_distinct("platform").alias("platforms"), F.count_distinct("location").alias("places")).head()

    e3 = written(E.by_platform(posts), "e3")
    n_posts, n_untagged, n_tagged, n_kinds = (F.lit(facts[k]) for k in ("posts", "untagged", "tagged", "platforms"))
    mean = twin.filter(tagged).groupBy("platform").agg((F.sum("total_engagement") / F.sum("rated")).alias("avg_total_engagement"))
    high, low = F.max("avg_total_engagement"), F.min("avg_total_engagement")

    m1 = written(E.by_location(users, posts), "m1")
    m1_twin = twin.filter(located).groupBy("location").agg(F.sum("total_engagement").alias("total_engagement"))
    n_places, n_joined = F.lit(facts["places"]), F.lit(facts["located"])
    top = [F.desc("total_engagement"), F.col("location")]
    m1_top, twin_top = m1.orderBy(*top).limit(3), m1_twin.orderBy(*top).limit(3)

    h2 = written(E.top_users_by_location(users, posts), "h2")
    per_user = twin.filter(located).groupBy("location", "user_id").agg(F.sum("total_engagement").alias("total_engagement"))
    best = written(E.top_user_per_location(users, posts), "best")
    h2_first = h2.filter(F.col("location_rank") == 1)
    active = per_user.groupBy("location").agg(F.count(F.lit(1)).alias("active"))
    small = h2.groupBy("location").agg(F.count(F.lit(1)).alias("n_rows")).join(active, "location").filter(
        (F.col("active") < 3) & (F.col("n_rows") > F.col("active"))
    )
    n = F.count(F.lit(1))
    return all_of(
        expect(e3, "E3.1 untagged posts are left out", F.sum("post_count"), F.sum("post_count") == n_posts - n_untagged),
        expect(e3, "E3.2 post counts add up", F.sum("post_count"), F.sum("post_count") == n_tagged),
        expect(e3, "E3.3 one row per platform", n, n == n_kinds),
        count_check(reconcile(e3, mean, ["platform"], "avg_total_engagement", 0.01), "E3.4 means agree"),
        expect(e3, "E3.5 spread below 10 percent", high, (high - low) / low < 0.10),
        expect(m1, "M1.1 one row per location", n, n == n_places),
        expect(m1, "M1.2 post counts add up", F.sum("post_count"), F.sum("post_count") == n_joined),
        count_check(m1_top.select("location").subtract(twin_top.select("location")), "M1.3 top three agree"),
        count_check(reconcile(m1, m1_twin, ["location"], "total_engagement", 1.0), "M1.4 totals agree"),
        repeat_check(h2, ["location", "user_id"], "H2.1 no repeated user in a location"),
        count_check(rank_order_breaks(h2, "location", "location_rank", "total_engagement"), "H2.2 ordered by engagement"),
        run_checks(h2, {"H2.3 ranks are 1 to 3": ~F.col("location_rank").isin(1, 2, 3)}),
        count_check(small, "H2.4 small locations list no extra users"),
        count_check(
            reconcile(h2, per_user.join(h2.select("location", "user_id"), ["location", "user_id"], "left_semi"),
                      ["location", "user_id"], "total_engagement", 1.0),
            "H2.5 totals agree",
        ),
        count_check(best.join(h2_first, ["location", "user_id"], "left_anti"), "H2.6 top user agrees"),
    )


def split_checks(
    split: DataFrame, text: str = "text_clean", label: str = "sentiment_label", tolerance_pp: float = 5.0, source: DataFrame | None = None,
) -> DataFrame:
    """No residue of raw markup, no leak, class shares near an even split, and no row lost from `source`."""
    from chirrup.operators.splits import split_leaks

    residue = run_checks(
        split,
        {
            "no unicode escapes left": F.col(text).rlike(X.ESCAPE),
            "no html entities left": F.col(text).rlike(X.ENTITY),
            "every row has a split": ~F.coalesce(F.col("split").isin("train", "val", "test"), F.lit(False)),
        },
    )
    suites = [residue, count_check(split_leaks(split, text), "no text in two splits"),
              count_check(unbalanced(split, ["split"], label, tolerance_pp), "class shares within tolerance")]
    if source is not None:
        parts = split.agg(F.count(F.lit(1)).alias("n"))
        off = parts.where(F.col("n") != source.agg(F.count(F.lit(1)).alias("n")).scalar())
        suites.append(count_check(off, "parts add up to the input"))
    return all_of(*suites)


def unbalanced(df: DataFrame, groups: Sequence[str], label: str, tolerance_pp: float) -> DataFrame:
    """Class shares of a group that differ from an even split by too much."""
    from pyspark.sql import Window

    cells = df.groupBy(*groups, label).agg(F.count(F.lit(1)).alias("n"))
    kinds = df.agg(F.count_distinct(label).alias("k")).scalar()
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*groups))
    return cells.withColumn("share", share).filter(F.abs(F.col("share") - 100.0 / kinds) > tolerance_pp)


def model_checks(
    predictions: DataFrame, classes: Sequence[str], floor: float = 0.40, reference_f1: float | None = None, max_gap: float = 0.05,
    balance_pp: Mapping[str, float] | None = None, part: str = "part",
) -> DataFrame:
    """Known labels, metrics above a floor, matrix rows equal to class support.

    With `balance_pp`, the true classes of each part of the scored rows (column
    `part`) are near an even split, within that many percentage points.
    """
    from chirrup.operators import evaluation as EV

    overall = EV.overall_metrics(predictions)
    support = predictions.groupBy(TRUE).agg(F.count(F.lit(1)).alias("support"))
    matrix = EV.confusion_matrix(predictions, classes)
    f1 = F.first("macro_f1")
    suites = [
        run_checks(predictions, {"labels are known": ~F.col(PRED).isin(*classes) | ~F.col(TRUE).isin(*classes)}),
        expect(overall, "accuracy above floor", F.first("accuracy"), F.first("accuracy") > floor),
        expect(overall, "macro F1 above floor", f1, f1 > floor),
        count_check(reconcile(matrix, support, [TRUE], "support", 0.0), "matrix rows equal support"),
    ]
    if reference_f1 is not None:
        suites.append(expect(overall, "gap to reference F1", f1, F.abs(f1 - reference_f1) <= max_gap))
    for name, points in (balance_pp or {}).items():
        suites.append(count_check(unbalanced(predictions.filter(F.col(part) == name), [part], TRUE, points), f"classes of {name} within {points:g} points"))
    return all_of(*suites)
