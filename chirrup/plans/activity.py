"""Queries on users and posts: cleaning, quality, engagement."""

from __future__ import annotations

from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C
from chirrup.operators import clean as CL, engagement as E, profile as PR, quality as Q, ranking as R, sketches as SK
from chirrup.plans import check_sql as S
from chirrup.plans.registry import Query
from chirrup.session import written
from chirrup.sources import files as FI, roles
from chirrup.sources.roles import dirty_posts, posts, raw_users, users

ENGAGEMENT = "coalesce(likes, 0) + shares + comments"
KNOWN = "CASE WHEN coalesce(likes, shares, comments) IS NOT NULL THEN coalesce(likes, 0) + coalesce(shares, 0) + coalesce(comments, 0) END"
PROFILED = ["platform", "text_content", "likes"]
NUMERIC = ["likes", "shares", "comments"]
POST_KEYS = {"post_id": ["post_id"], "full_row": list(FI.RAW_POSTS), "text": ["text_content"]}
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# The same three standing questions as SQL text, for the named-query source.
LOCATION_LEADERS = """
WITH per_author AS (
    SELECT user_id, count(*) AS post_count, sum(coalesce(likes, 0) + shares + comments) AS total_engagement
    FROM {posts} GROUP BY user_id
), placed AS (
    SELECT location, user_id, follower_count, post_count, total_engagement,
           rank() OVER (PARTITION BY location ORDER BY total_engagement DESC) AS location_rank
    FROM per_author JOIN {users} USING (user_id)
)
SELECT location, CAST(location_rank AS BIGINT) AS location_rank, user_id, follower_count, post_count, total_engagement
FROM placed WHERE location_rank <= 3
"""


def _rounded(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def leaders_sql(spark, d):
    return FI.run_sql(spark, LOCATION_LEADERS, {"posts": posts(spark, d), "users": users(spark, d)})


def engagement_by_platform(spark, d):
    return _rounded(E.by_platform(posts(spark, d)), 6, "avg_likes", "avg_shares", "avg_comments", "avg_total_engagement")


def tied_locations(spark, d):
    """Locations whose third place is shared when users are ranked by whole ten thousands of engagement."""
    coarse = E.author_totals(users(spark, d), posts(spark, d)).withColumn("total_engagement", F.floor(F.col("total_engagement") / 10_000))
    return E.location_ties(R.top_per_group(coarse, ["location"], [F.desc("total_engagement")], 3, "location_rank", ties=True))


def follower_corr(spark, d):
    return _rounded(E.follower_correlation(users(spark, d), posts(spark, d)), 9, "corr_engagement", "corr_likes")


def deciles(spark, d):
    return _rounded(E.follower_deciles(users(spark, d), posts(spark, d)), 6, "top_cut", "bottom_cut", "top_mean", "bottom_mean", "gap_pct")


def spread(spark, d):
    return _rounded(E.platform_spread(posts(spark, d)), 6, "lowest", "highest", "spread_pct")


def histogram(spark, d):
    return E.histogram(posts(spark, d), "likes", 40)


def cleaned(spark, d):
    c = CL.clean_posts(dirty_posts(spark, d))
    return c.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


def cleaned_users(spark, d):
    u = CL.clean_users(raw_users(spark, d))
    return u.withColumn("account_created", F.col("account_created").cast("string"))


def orphan_rows(spark, d):
    """Posts whose author is not among the users with a positive balance."""
    known = users(spark, d).filter(F.col("follower_count") > 0)
    p = posts(spark, d)
    lost = CL.orphans(p, known).select("post_id", F.lit("orphan").alias("side"))
    kept = CL.with_known_user(p, known).select("post_id", F.lit("known").alias("side"))
    return lost.unionByName(kept)


def sign_profile(spark, d):
    return _rounded(PR.sign_profile(dirty_posts(spark, d)), 6, "mean", "std")


def error_month(spark, d):
    rate = E.negative_likes_rate(dirty_posts(spark, d), E.raw_month(), "month")
    return _rounded(rate, 9, "negative_rate")


def error_platform(spark, d):
    return _rounded(E.negative_likes_rate(dirty_posts(spark, d), E.platform_or_missing(), "platform"), 9, "negative_rate")


def twin_month(spark, d):
    return _rounded(E.duplicate_rate_by_month(dirty_posts(spark, d)), 9, "duplicate_rate")


def completeness(spark, d):
    return _rounded(E.completeness(CL.typed_posts(dirty_posts(spark, d))), 9, "likes_present_rate")


def tidy_text(spark, d):
    return dirty_posts(spark, d).select(C.normalize_missing("text_content").alias("text_content"))


def quality_checks(spark, d):
    p = CL.clean_posts(dirty_posts(spark, d))
    return Q.user_post_checks(CL.clean_users(raw_users(spark, d)), p, PRIORITIES, "2015-03-01 00:00:00", "2021-06-30 23:59:59")


def result_checks(spark, d):
    return Q.result_checks(users(spark, d), posts(spark, d))


def reconciliation(spark, d):
    """Per-user likes against shares: keys that differ by more than one."""
    p = posts(spark, d)
    likes = p.groupBy("user_id").agg(F.sum("likes").cast("double").alias("v"))
    shares = p.groupBy("user_id").agg(F.sum("shares").cast("double").alias("v"))
    return Q.reconcile(likes, shares, ["user_id"], "v", 1.0)


def loaded(spark, d):
    """Idempotent load of users and posts into written tables."""
    from chirrup.session import fresh_dir

    return FI.load_tables(spark, {"loaded_users": users(spark, d), "loaded_posts": posts(spark, d)}, fresh_dir(spark, "load"))


def round_trip(spark, d):
    """Dirty posts written as CSV text and read back untyped."""
    from chirrup.session import fresh_dir

    path = fresh_dir(spark, "csv")
    FI.write_csv(dirty_posts(spark, d), path, FI.RAW_POSTS)
    raw = FI.read_raw_csv(spark, path, FI.RAW_POSTS)
    return raw.groupBy(C.timestamp_format("timestamp").alias("format")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text_content").cast("bigint")).alias("chars"),
        F.count_if(C.is_missing("platform")).alias("missing_platform"),
    )


def stored_clean(spark, d):
    """Cleaned posts written by month and read back through the typed schema."""
    from chirrup.session import fresh_dir

    path = fresh_dir(spark, "silver")
    c = CL.clean_posts(dirty_posts(spark, d)).withColumn("month", F.date_format("event_time", "yyyy-MM"))
    FI.write_table(c, path, FI.CLEAN_POSTS, "month")
    back = FI.read_table(spark, path, FI.POSTS_SCHEMA + ", month string")
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("likes").alias("likes"))


def reloaded(spark, d):
    """The same table after one month was corrected and loaded again, twice; other months stay."""
    from chirrup.session import fresh_dir

    path = fresh_dir(spark, "silver")
    c = CL.clean_posts(dirty_posts(spark, d)).withColumn("month", F.date_format("event_time", "yyyy-MM"))
    FI.write_table(c, path, FI.CLEAN_POSTS, "month", sort_by=["event_time"])
    mended = c.filter("month = '1996-03'").withColumn("likes", F.col("likes") + 1)
    for _ in range(2):
        FI.write_table(mended, path, FI.CLEAN_POSTS, "month", "partitions", ["event_time"])
    back = FI.read_table(spark, path, FI.POSTS_SCHEMA + ", month string")
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("likes").alias("likes"))


def sketched_distinct(spark, d):
    """Distinct authors and platforms over all posts from merged monthly sketches, against the exact numbers."""
    columns = ["user_id", "platform", "post_id"]
    monthly = written(SK.distinct_sketches(posts(spark, d).withColumn("month", F.date_format("event_time", "yyyy-MM")), columns, ["month"]), "sketches")
    found = SK.distinct_estimates(SK.merged_distinct(monthly, columns), columns)
    exact = posts(spark, d).agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "n_distinct")
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return exact.join(found, "column_name").select("column_name", "n_distinct", near.alias("within"))


def sketched_quantiles(spark, d):
    """Deciles of likes and shares from merged monthly sketches: within one and a half percent of their rank."""
    columns, shares = ["likes", "shares"], [i / 10 for i in range(1, 10)]
    p = posts(spark, d)
    monthly = written(SK.quantile_sketches(p.withColumn("month", F.date_format("event_time", "yyyy-MM")), columns, ["month"]), "sketches")
    merged = SK.merged_quantiles(monthly, columns)
    found = merged.select(F.struct(*[F.array(*[SK.quantile(c, s) for s in shares]).alias(c) for c in columns]).alias("q")).scalar()
    errors = p.agg(*[F.array(*[SK.rank_error(p, c, F.get(found[c], F.lit(i)), s) for i, s in enumerate(shares)]).alias(c) for c in columns])
    long = errors.unpivot([], columns, "column_name", "errors").select("column_name", F.posexplode("errors").alias("at", "error"))
    return long.select("column_name", ((F.col("at") + 1) / 10).alias("p"), (F.col("error") <= 0.015).alias("within"))


def sketched_deciles(spark, d):
    """Follower cuts of the sketch: as far from ranks 0.1 and 0.9 of the posts as the sketch may be."""
    u, p = users(spark, d), posts(spark, d)
    cuts = SK.follower_deciles_sketched(u, p).select(F.struct("bottom_cut", "top_cut").alias("c")).scalar()
    rows = p.join(u, "user_id").select(F.col("follower_count").alias("v"))
    errors = rows.agg(SK.rank_error(rows, "v", cuts["bottom_cut"], 0.1).alias("bottom"), SK.rank_error(rows, "v", cuts["top_cut"], 0.9).alias("top"))
    return errors.unpivot([], ["bottom", "top"], "cut", "error").select("cut", (F.col("error") <= 0.015).alias("within"))


def first_rows(spark, d):
    text = F.col("text_content")
    return PR.first_examples(
        dirty_posts(spark, d).withColumn("n", F.col("post_id").cast("bigint")).dropDuplicates(["post_id"]),
        text.contains("@user"), "n", ["text_content"],
    )


def sample(spark, d):
    return R.seeded_sample(posts(spark, d).select("post_id", "user_id"), "post_id", 3000)


def ties(spark, d):
    ranked = E.top_users_by_location(users(spark, d), posts(spark, d))
    return ranked.groupBy("location").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("location_rank") == 3).alias("n_last")
    )


_LEADERS = S.with_views("users", "posts", ue=f"""
    SELECT u.user_id, u.location, u.follower_count, count(*) AS post_count,
           CAST(sum({ENGAGEMENT}) AS BIGINT) AS total_engagement
    FROM users u JOIN posts p ON u.user_id = p.user_id GROUP BY ALL""", ranked="""
    SELECT *, rank() OVER (PARTITION BY location ORDER BY total_engagement DESC) AS location_rank FROM ue""")
_LEADERS_OUT = f"""{_LEADERS}
    SELECT location, location_rank, user_id, follower_count, post_count, total_engagement
    FROM ranked WHERE location_rank <= 3"""

_CLEAN = S.with_views("timed", clean=f"""
    SELECT DISTINCT post_id, user_id, platform_n AS platform, {S.strip(S.unescape('text_n'))} AS text_content,
           "timestamp" AS timestamp_raw, event_time, abs(likes_n) AS likes,
           CAST(shares AS BIGINT) AS shares, CAST(comments AS BIGINT) AS comments FROM timed""")


def _profile_rows(rows):
    return " UNION ALL ".join(rows)


_CHECK_ROWS = [
    ("users: user_id is unique", "SELECT count(*) - count(DISTINCT user_id) FROM cu"),
    ("users: no missing values", "SELECT count(*) FROM cu WHERE user_id IS NULL OR location IS NULL OR language IS NULL OR account_created IS NULL OR follower_count IS NULL"),
    ("users: follower_count is not negative", "SELECT count(*) FROM cu WHERE follower_count < 0"),
    ("users: account_created is a date", "SELECT count(*) FROM cu WHERE account_created IS NULL"),
    ("posts: no repeated rows", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) FROM clean"),
    ("posts: post_id is unique", "SELECT count(*) - count(DISTINCT post_id) FROM clean"),
    ("posts: user_id exists", "SELECT count(*) FROM clean WHERE user_id NOT IN (SELECT user_id FROM cu)"),
    ("posts: likes is not negative", "SELECT count(*) FROM clean WHERE likes < 0"),
    ("posts: shares is present and not negative", "SELECT count(*) FROM clean WHERE shares IS NULL OR shares < 0"),
    ("posts: comments is present and not negative", "SELECT count(*) FROM clean WHERE comments IS NULL OR comments < 0"),
    ("posts: event_time is present", "SELECT count(*) FROM clean WHERE event_time IS NULL"),
    ("posts: platform is a known one", f"SELECT count(*) FROM clean WHERE platform NOT IN ({S.listing(PRIORITIES)})"),
    ("posts: no placeholder text", "SELECT count(*) FROM clean WHERE lower(platform) IN ('nan','null','none','') OR lower(text_content) IN ('nan','null','none','')"),
    ("posts: event_time is in the campaign window", "SELECT count(*) FROM clean WHERE event_time IS NULL OR event_time < TIMESTAMP '2015-03-01 00:00:00' OR event_time > TIMESTAMP '2021-06-30 23:59:59'"),
    ("posts: not before the account was created", "SELECT count(*) FROM clean JOIN cu USING (user_id) WHERE event_time < account_created"),
]
_CHECKS = (
    S.with_views("timed", "raw_users")
    + ",\n" + _CLEAN.split(",\nclean AS ")[1].join(["clean AS ", ""])
    + """,
    cu AS (SELECT DISTINCT trim(user_id) AS user_id, trim(location) AS location, trim(language) AS language,
                  CAST(account_created AS DATE) AS account_created, CAST(follower_count AS BIGINT) AS follower_count FROM raw_users)
    SELECT "check", violations, violations = 0 AS passed FROM ("""
    + _profile_rows([f'SELECT {S.quote(n)} AS "check", ({q}) AS violations' for n, q in _CHECK_ROWS])
    + ")"
)

_RESULTS = S.with_views(
    "users", "posts",
    e3=f"""SELECT platform, count(*) AS n, avg({ENGAGEMENT}) AS m FROM posts WHERE platform IS NOT NULL GROUP BY 1""",
    e3b=f"""SELECT platform, sum({ENGAGEMENT}) / count(*) AS m FROM posts WHERE platform IS NOT NULL GROUP BY 1""",
    j=f"""SELECT location, user_id, follower_count, {ENGAGEMENT} AS e FROM posts JOIN users USING (user_id)""",
    m1="SELECT location, count(*) AS n, sum(e) AS t FROM j GROUP BY 1",
    m1b="SELECT location, sum(t) AS t FROM (SELECT location, user_id, sum(e) AS t FROM j GROUP BY ALL) GROUP BY 1",
    ue="SELECT location, user_id, sum(e) AS t FROM j GROUP BY ALL",
    h2="SELECT * FROM (SELECT *, rank() OVER (PARTITION BY location ORDER BY t DESC) AS r FROM ue) WHERE r <= 3",
    o="SELECT *, lag(t) OVER (PARTITION BY location ORDER BY r, t DESC) AS before FROM h2",
    best="SELECT location, user_id FROM ue QUALIFY row_number() OVER (PARTITION BY location ORDER BY t DESC, user_id) = 1",
)


def _unless(condition):
    return f"SELECT CASE WHEN {condition} THEN 0 ELSE 1 END"


_RESULT_ROWS = [
    ("E3.1 untagged posts are left out", _unless("(SELECT sum(n) FROM e3) = (SELECT count(*) - count(*) FILTER (WHERE platform IS NULL) FROM posts)")),
    ("E3.2 post counts add up", _unless("(SELECT sum(n) FROM e3) = (SELECT count(platform) FROM posts)")),
    ("E3.3 one row per platform", _unless("(SELECT count(*) FROM e3) = (SELECT count(DISTINCT platform) FROM posts)")),
    ("E3.4 means agree", "SELECT count(*) FROM e3 FULL JOIN e3b USING (platform) WHERE e3.m IS NULL OR e3b.m IS NULL OR abs(e3.m - e3b.m) > 0.01"),
    ("E3.5 spread below 10 percent", _unless("(SELECT (max(m) - min(m)) / min(m) FROM e3) < 0.10")),
    ("M1.1 one row per location", _unless("(SELECT count(*) FROM m1) = (SELECT count(DISTINCT location) FROM j)")),
    ("M1.2 post counts add up", _unless("(SELECT sum(n) FROM m1) = (SELECT count(*) FROM j)")),
    ("M1.3 top three agree", "SELECT count(*) FROM (SELECT location FROM (FROM m1 ORDER BY t DESC, location LIMIT 3) EXCEPT SELECT location FROM (FROM m1b ORDER BY t DESC, location LIMIT 3))"),
    ("M1.4 totals agree", "SELECT count(*) FROM m1 FULL JOIN m1b USING (location) WHERE m1.t IS NULL OR m1b.t IS NULL OR abs(m1.t - m1b.t) > 1"),
    ("H2.1 no repeated user in a location", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT location, user_id FROM h2)) FROM h2"),
    ("H2.2 ordered by engagement", "SELECT count(*) FROM o WHERE t > before"),
    ("H2.3 ranks are 1 to 3", "SELECT count(*) FROM h2 WHERE r NOT IN (1, 2, 3)"),
    ("H2.4 small locations list no extra users", "SELECT count(*) FROM (SELECT location, count(*) AS a FROM ue GROUP BY 1) JOIN (SELECT location, count(*) AS n FROM h2 GROUP BY 1) USING (location) WHERE a < 3 AND n > a"),
    ("H2.5 totals agree", "SELECT count(*) FROM h2 JOIN ue USING (location, user_id) WHERE abs(h2.t - ue.t) > 1"),
    ("H2.6 top user agrees", "SELECT count(*) FROM best WHERE NOT EXISTS (SELECT 1 FROM h2 WHERE r = 1 AND h2.location = best.location AND h2.user_id = best.user_id)"),
]

QUERIES: dict[str, Query] = {
    "h2_top_users_by_location": Query(
        lambda s, d: E.top_users_by_location(users(s, d), posts(s, d)), _LEADERS_OUT),
    "named_sql_top_users": Query(leaders_sql, _LEADERS_OUT),
    "h2_top_user_per_location": Query(
        lambda s, d: E.top_user_per_location(users(s, d), posts(s, d)),
        f"""{_LEADERS} SELECT location, user_id, total_engagement FROM ranked
        QUALIFY row_number() OVER (PARTITION BY location ORDER BY total_engagement DESC, user_id) = 1"""),
    "h2_location_ties": Query(ties, f"""{_LEADERS} SELECT location, count(*) AS n_rows,
        count(*) FILTER (WHERE location_rank = 3) AS n_last FROM ranked WHERE location_rank <= 3 GROUP BY location"""),
    "h2_tied_locations": Query(tied_locations, f"""{S.with_views('users', 'posts')},
        per_user AS (SELECT location, user_id, floor(sum({ENGAGEMENT}) / 10000) AS k FROM posts JOIN users USING (user_id) GROUP BY ALL),
        placed AS (SELECT location, (SELECT count(*) FROM per_user b WHERE b.location IS NOT DISTINCT FROM a.location AND b.k > a.k) + 1 AS place FROM per_user a)
        SELECT location, count(*) AS n_rows, count(*) FILTER (WHERE place = 3) AS n_last FROM placed WHERE place <= 3 GROUP BY location
        HAVING count(*) > 3 OR count(*) FILTER (WHERE place = 3) > 1"""),
    "e3_engagement_by_platform": Query(engagement_by_platform, f"""{S.with_views('posts')}
        SELECT platform, count(*) AS post_count, round(avg(likes), 6) AS avg_likes, round(avg(shares), 6) AS avg_shares,
               round(avg(comments), 6) AS avg_comments, round(avg({ENGAGEMENT}), 6) AS avg_total_engagement
        FROM posts WHERE platform IS NOT NULL GROUP BY platform"""),
    "m1_engagement_by_location": Query(
        lambda s, d: E.by_location(users(s, d), posts(s, d)), f"""{S.with_views('users', 'posts')}
        SELECT location, count(*) AS post_count, CAST(sum({ENGAGEMENT}) AS BIGINT) AS total_engagement,
               round(avg({ENGAGEMENT}), 1) AS avg_engagement_per_post
        FROM users JOIN posts USING (user_id) GROUP BY location"""),
    "follower_engagement_corr": Query(follower_corr, f"""{S.with_views('users', 'posts')}
        SELECT round(corr(follower_count, {KNOWN}), 9) AS corr_engagement, round(corr(follower_count, likes), 9) AS corr_likes
        FROM posts LEFT JOIN users USING (user_id)"""),
    "follower_deciles": Query(deciles, f"""{S.with_views('users', 'posts', m=f'''
        SELECT follower_count AS f, {KNOWN} AS e FROM posts LEFT JOIN users USING (user_id)''',
        c='SELECT quantile_cont(f, 0.9) AS hi, quantile_cont(f, 0.1) AS lo FROM m', r='''
        SELECT max(hi) AS hi, max(lo) AS lo, avg(e) FILTER (WHERE f >= hi) AS t, avg(e) FILTER (WHERE f <= lo) AS b FROM m, c''')}
        SELECT round(hi, 6) AS top_cut, round(lo, 6) AS bottom_cut, round(t, 6) AS top_mean, round(b, 6) AS bottom_mean,
               round(abs(t - b) / b * 100, 6) AS gap_pct FROM r"""),
    "platform_spread": Query(spread, f"""{S.with_views('posts', m=f'''
        SELECT avg({KNOWN}) AS v FROM posts WHERE platform IS NOT NULL GROUP BY platform''')}
        SELECT round(min(v), 6) AS lowest, round(max(v), 6) AS highest, round((max(v) - min(v)) / min(v) * 100, 6) AS spread_pct FROM m"""),
    "value_histogram": Query(histogram, f"""{S.with_views('posts', b='''
        SELECT CAST(min(likes) AS DOUBLE) AS lo, CAST(max(likes) AS DOUBLE) AS hi FROM posts''')}
        SELECT CAST(least(floor((likes - lo) / (hi - lo) * 40), 39) AS BIGINT) AS bin, count(*) AS n
        FROM posts, b WHERE likes IS NOT NULL GROUP BY 1"""),
    "monthly_volume": Query(
        lambda s, d: E.monthly_volume(posts(s, d)).withColumn("month", F.col("month").cast("string")),
        f"""{S.with_views('posts', m='''SELECT date_trunc('month', event_time) AS month, count(*) AS n FROM posts GROUP BY 1''',
        spine="SELECT unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH)) AS month")}
        SELECT strftime(spine.month, '%Y-%m-%d') AS month, coalesce(n, 0) AS posts FROM spine LEFT JOIN m ON spine.month = m.month"""),
    "class_shares": Query(
        lambda s, d: E.class_shares(posts(s, d), "platform"), f"""{S.with_views('posts')}
        SELECT platform AS label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM posts), 1) AS pct
        FROM posts GROUP BY platform"""),
    "clean_posts": Query(cleaned, f"""{_CLEAN} SELECT * REPLACE (strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time) FROM clean"""),
    "clean_users": Query(cleaned_users, f"""{S.with_views('raw_users')}
        SELECT DISTINCT trim(user_id) AS user_id, trim(location) AS location, trim(language) AS language,
               account_created, CAST(follower_count AS BIGINT) AS follower_count FROM raw_users"""),
    "orphan_posts": Query(orphan_rows, f"""{S.with_views('users', 'posts')}
        SELECT post_id, CASE WHEN user_id IN (SELECT user_id FROM users WHERE follower_count > 0) THEN 'known' ELSE 'orphan' END AS side
        FROM posts"""),
    "timestamp_formats": Query(
        lambda s, d: PR.timestamp_formats(dirty_posts(s, d)),
        f"{S.with_views('tidy')} SELECT format, count(*) AS n FROM tidy GROUP BY format"),
    "missing_profile": Query(
        lambda s, d: PR.missing_profile(dirty_posts(s, d), PROFILED),
        f"{S.with_views('dirty')} " + _profile_rows([
            f"SELECT '{c}' AS column_name, n AS n_missing, round(100.0 * n / t, 1) AS pct_missing FROM (SELECT count(*) FILTER (WHERE upper(trim({c})) IN ({S.listing(P.NULL_LITERALS)})) AS n, count(*) AS t FROM dirty)"
            for c in PROFILED])),
    "numeric_profile": Query(
        lambda s, d: PR.numeric_profile(dirty_posts(s, d), NUMERIC),
        f"{S.with_views('dirty')} " + _profile_rows([
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE v IS NULL) AS non_numeric, count(*) FILTER (WHERE v < 0) AS negative, min(v) AS min_value, max(v) AS max_value FROM (SELECT TRY_CAST({c} AS BIGINT) AS v FROM dirty)"
            for c in NUMERIC])),
    "sign_profile": Query(sign_profile, f"""{S.with_views('tidy')}
        SELECT CASE WHEN likes_n < 0 THEN 'negative' ELSE 'positive' END AS side, count(*) AS n, round(avg(abs(likes_n)), 6) AS mean,
               round(stddev_samp(abs(likes_n)), 6) AS std, min(abs(likes_n)) AS min_value, max(abs(likes_n)) AS max_value
        FROM tidy WHERE likes_n IS NOT NULL GROUP BY 1"""),
    "date_profile": Query(
        lambda s, d: PR.date_profile(raw_users(s, d), "account_created").select(
            "unparsable", F.col("min_date").cast("string").alias("min_date"), F.col("max_date").cast("string").alias("max_date")),
        f"""{S.with_views('raw_users', v='SELECT TRY_CAST(account_created AS DATE) AS v FROM raw_users')}
        SELECT count(*) FILTER (WHERE v IS NULL) AS unparsable, CAST(min(v) AS VARCHAR) AS min_date, CAST(max(v) AS VARCHAR) AS max_date FROM v"""),
    "distinct_values": Query(
        lambda s, d: PR.distinct_values(raw_users(s, d), ["location", "language"]),
        f"""{S.with_views('raw_users')} SELECT 'location' AS column_name, count(DISTINCT trim(location)) AS n_distinct FROM raw_users
        UNION ALL SELECT 'language', count(DISTINCT trim(language)) FROM raw_users"""),
    "value_list": Query(
        lambda s, d: PR.value_list(dirty_posts(s, d), "platform"),
        f"{S.with_views('tidy')} SELECT DISTINCT platform_n AS value FROM tidy WHERE platform_n IS NOT NULL"),
    "duplicate_profile": Query(
        lambda s, d: PR.duplicate_profile(dirty_posts(s, d), POST_KEYS),
        f"{S.with_views('dirty')} " + _profile_rows([
            f"""SELECT '{name}' AS key_name, CAST(sum(n - 1) AS BIGINT) AS extra_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_groups,
            count(*) FILTER (WHERE n > 1) AS groups FROM (SELECT count(*) AS n FROM dirty GROUP BY {', '.join('"' + c + '"' for c in cols)})"""
            for name, cols in POST_KEYS.items()])),
    "error_rate_by_month": Query(error_month, f"""{S.with_views('timed')}
        SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n, round(avg(CASE WHEN likes_n < 0 THEN 1.0 ELSE 0.0 END), 9) AS negative_rate
        FROM timed WHERE likes_n IS NOT NULL GROUP BY 1"""),
    "error_rate_by_platform": Query(error_platform, f"""{S.with_views('tidy')}
        SELECT coalesce(platform_n, 'Missing') AS platform, count(*) AS n, round(avg(CASE WHEN likes_n < 0 THEN 1.0 ELSE 0.0 END), 9) AS negative_rate
        FROM tidy WHERE likes_n IS NOT NULL GROUP BY 1"""),
    "duplicate_rate_by_month": Query(twin_month, f"""{S.with_views('timed', t='''
        SELECT *, count(*) OVER (PARTITION BY post_id, user_id, platform, text_content, "timestamp", likes, shares, comments) AS c FROM timed''')}
        SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n, round(avg(CASE WHEN c > 1 THEN 1.0 ELSE 0.0 END), 9) AS duplicate_rate
        FROM t GROUP BY 1"""),
    "completeness_by_platform": Query(completeness, f"""{S.with_views('tidy')}
        SELECT platform_n IS NOT NULL AS has_platform, count(*) AS n, round(avg(CASE WHEN likes_n IS NOT NULL THEN 1.0 ELSE 0.0 END), 9) AS likes_present_rate
        FROM tidy GROUP BY 1"""),
    "phrase_contingency": Query(
        lambda s, d: E.phrase_contingency(tidy_text(s, d)), f"""{S.with_views('tidy', f=f'''
        SELECT {S.any_phrase('text_n', P.POSITIVE_PHRASES)} AS p, {S.any_phrase('text_n', P.NEGATIVE_PHRASES)} AS n FROM tidy WHERE text_n IS NOT NULL''')}
        SELECT CASE WHEN p AND n THEN 'both' WHEN p THEN 'positive only' WHEN n THEN 'negative only' ELSE 'neither' END AS cue,
               count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM f), 1) AS pct FROM f GROUP BY 1"""),
    "hashtag_top": Query(
        lambda s, d: E.hashtag_counts(tidy_text(s, d), n=5), f"""{S.with_views('tidy', x='SELECT text_n FROM tidy WHERE text_n IS NOT NULL',
        t='''SELECT unnest(regexp_extract_all(text_n, '#([\\p{L}\\p{N}_]+)', 1)) AS tag FROM x''')}
        SELECT tag, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM x), 1) AS pct_of_texts FROM t GROUP BY tag ORDER BY n DESC, tag LIMIT 5"""),
    "dq_users_posts": Query(quality_checks, _CHECKS),
    "dq_results": Query(
        result_checks,
        f"{_RESULTS} SELECT \"check\", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM ("
        + _profile_rows([f'SELECT {S.quote(n)} AS "check", ({q}) AS violations' for n, q in _RESULT_ROWS]) + ")"),
    "reconciliation": Query(reconciliation, f"""{S.with_views('posts')}
        SELECT user_id, CAST(sum(likes) AS DOUBLE) AS left_value, CAST(sum(shares) AS DOUBLE) AS right_value FROM posts GROUP BY user_id
        HAVING sum(likes) IS NULL OR abs(sum(likes) - sum(shares)) > 1"""),
    "load_tables": Query(loaded, f"""{S.with_views('users', 'posts')}
        SELECT 'loaded_users' AS table_name, count(*) AS source_rows, count(*) AS stored_rows, true AS passed FROM users
        UNION ALL SELECT 'loaded_posts', count(*), count(*), true FROM posts"""),
    "csv_round_trip": Query(round_trip, f"""{S.with_views('tidy')}
        SELECT format, count(*) AS n, CAST(sum(length(text_content)) AS BIGINT) AS chars, count(*) FILTER (WHERE platform_n IS NULL) AS missing_platform
        FROM tidy GROUP BY format"""),
    "stored_clean_posts": Query(stored_clean, f"""{_CLEAN}
        SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes FROM clean GROUP BY 1"""),
    "reloaded_month": Query(reloaded, f"""{_CLEAN}
        SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n,
               CAST(sum(likes) + CASE WHEN strftime(event_time, '%Y-%m') = '1996-03' THEN count(likes) ELSE 0 END AS BIGINT) AS likes FROM clean GROUP BY 1"""),
    "sketched_distinct": Query(sketched_distinct, f"""{S.with_views('posts')}
        SELECT 'user_id' AS column_name, count(DISTINCT user_id) AS n_distinct, true AS within FROM posts
        UNION ALL SELECT 'platform', count(DISTINCT platform), true FROM posts UNION ALL SELECT 'post_id', count(DISTINCT post_id), true FROM posts"""),
    "sketched_quantiles": Query(sketched_quantiles, f"""{S.with_views('posts')}
        SELECT c AS column_name, i / 10 AS p, count(*) > 0 AS within FROM posts, (SELECT unnest(['likes', 'shares']) AS c), range(1, 10) t(i) GROUP BY ALL"""),
    "sketched_deciles": Query(sketched_deciles, f"""{S.with_views('posts')}
        SELECT unnest(['bottom', 'top']) AS cut, count(*) > 0 AS within FROM posts"""),
    "first_examples": Query(first_rows, f"""{S.with_views('dirty')}
        SELECT DISTINCT CAST(post_id AS BIGINT) AS n, text_content FROM dirty WHERE contains(text_content, '@user') ORDER BY n LIMIT 3"""),
    "row_sample": Query(sample, f"""{S.with_views('posts')}
        SELECT post_id, user_id FROM posts ORDER BY md5('42:' || post_id), post_id LIMIT 3000"""),
}
