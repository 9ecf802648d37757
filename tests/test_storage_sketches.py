"""Table layout and reloads; sketches against exact numbers."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from chirrup.operators import sketches as SK
from chirrup.sources import files as FI


def files(path, month):
    return {os.path.basename(f): os.path.getsize(f) for f in glob.glob(f"{path}/month={month}/*.parquet")}


def test_files_are_even_and_months_reload(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "64"}
    held = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        path = f"{tmp_path}/t"
        rows = spark.range(0, 60_000, 1, 8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 10 < 9, "2024-01").otherwise(F.concat(F.lit("2024-0"), (F.col("id") % 7 + 2).cast("string"))).alias("month"))
        FI.write_table(rows, path, ["id", "text"], "month", sort_by=["id"])
        hot = files(path, "2024-01")
        assert len(hot) > 4 and max(hot.values()) <= 3 * min(sorted(hot.values())[1:])  # one rest may be small
        small = files(path, "2024-03")
        assert len(small) <= 2
        mended = rows.where("month = '2024-03'").withColumn("text", F.lit("mended"))
        for _ in range(2):
            FI.write_table(mended, path, ["id", "text"], "month", "partitions")
        assert files(path, "2024-01") == hot
        back = FI.read_table(spark, path, "id long, text string, month string")
        assert back.count() == 60_000 and back.where("text = 'mended'").count() == mended.count() and back.select("id").distinct().count() == 60_000
        FI.write_table(mended, path, ["id", "text"], "month")
        assert files(path, "2024-01") == {}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_write_modes(spark, tmp_path):
    df = spark.createDataFrame([(2, "a"), (1, "b")], "id int, text string")
    FI.write_table(df, f"{tmp_path}/plain", ["text", "id"], sort_by=["id"])
    assert spark.read.parquet(f"{tmp_path}/plain").columns == ["text", "id"]
    for bad in ({"replace": "partitions"}, {"replace": "rows"}):
        with pytest.raises(ValueError):
            FI.write_table(df, f"{tmp_path}/plain", ["id"], **bad)
    FI.write_table(df.limit(0), f"{tmp_path}/plain", ["text", "id"])
    assert spark.read.schema("text string, id int").parquet(f"{tmp_path}/plain").count() == 0


def test_merged_sketches_stay_within_bounds(spark):
    rng = random.Random(1)
    data = [(i % 12, f"u{rng.randrange(5000)}", rng.lognormvariate(3, 2), None) for i in range(40_000)]
    df = spark.createDataFrame(data, "day int, user string, value double, nothing string").repartition(6)
    daily = SK.distinct_sketches(df, ["user", "nothing"], ["day"])
    whole = {r.column_name: r.estimate for r in SK.distinct_estimates(SK.merged_distinct(daily, ["user", "nothing"]), ["user", "nothing"]).collect()}
    exact = len({r[1] for r in data})
    assert abs(whole["user"] - exact) <= 0.05 * exact and whole["nothing"] == 0
    by_day = SK.distinct_estimates(daily, ["user"], ["day"]).collect()
    assert len(by_day) == 12
    for r in by_day:
        n = len({x[1] for x in data if x[0] == r.day})
        assert abs(r.estimate - n) <= 0.05 * n
    direct = {r.column_name: r.estimate for r in SK.distinct_estimates(SK.distinct_sketches(df, ["user"]), ["user"]).collect()}
    assert abs(direct["user"] - whole["user"]) <= 0.01 * exact  # merging adds next to nothing

    merged = SK.merged_quantiles(SK.quantile_sketches(df, ["value"], ["day"]), ["value"])
    values = sorted(r[2] for r in data)
    for p in (0.01, 0.1, 0.5, 0.9, 0.99):
        v = merged.select(SK.quantile("value", p).alias("v")).head().v
        low, high = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
        assert low - 0.015 <= p <= high + 0.015
        assert df.agg(SK.rank_error(df, "value", F.lit(v), p).alias("e")).head().e <= 0.015


def test_sketched_deciles_near_the_exact_cuts(spark):
    from chirrup.operators import engagement as E

    rng = random.Random(2)
    users = spark.createDataFrame([(i, int(rng.lognormvariate(6, 1)) if i % 20 else None) for i in range(800)], "user_id long, follower_count long")
    posts = spark.createDataFrame([(i, 5 if rng.random() < 0.3 else rng.randrange(900), rng.randrange(50), 1, 2) for i in range(20_000)],
                                  "post_id long, user_id long, likes long, shares long, comments long")
    rough, exact = SK.follower_deciles_sketched(users, posts).head(), E.follower_deciles(users, posts).head()
    rows = sorted(r.follower_count for r in posts.join(users, "user_id").where("follower_count IS NOT NULL").collect())
    for cut, p in ((rough.bottom_cut, 0.1), (rough.top_cut, 0.9)):
        assert sum(v < cut for v in rows) / len(rows) - 0.015 <= p <= sum(v <= cut for v in rows) / len(rows) + 0.015
    assert abs(rough.top_mean - exact.top_mean) < 2 and abs(rough.bottom_mean - exact.bottom_mean) < 2
    none = SK.follower_deciles_sketched(users, posts.limit(0)).head()
    assert none.top_cut is None and none.top_mean is None
