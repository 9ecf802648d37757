"""Stored streams: late keys, replays, restarts, compaction, and the batch form they must equal."""

import datetime as dt
import glob
import os
import random

import pytest

from chirrup.operators import timeline as TL
from chirrup.streaming import posts as ST, store as SO

PAIRS = "post_uri string, arrival int"
HOURS = "ts timestamp, engagement long, sentiment_label string"


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def merged(spark, out):
    return sorted((r.post_uri, r.arrival) for r in ST.read_merged(spark, out, PAIRS).collect())


def test_merge_with_late_keys_replays_and_restarts(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    want = {}
    rng = random.Random(2)
    for step in range(4):
        rows = [(f"k{rng.randrange(40)}", 100 * step + i) for i in range(20)] + [("first", step), (None, 1), ("", 2)]
        for key, arrival in sorted(rows, key=lambda r: r[1]):
            if key:
                want.setdefault(key, arrival)
        add(spark, source, rows, PAIRS)
        ST.start_merge(stream_of(spark, source, PAIRS), out, state, buckets=8).awaitTermination()
        assert merged(spark, out) == sorted(want.items())
    replay = ST.merge_batch(out, "post_uri", "arrival", ST.run_name(state), 8)
    replay(spark.createDataFrame(rows, PAIRS), 3)
    assert merged(spark, out) == sorted(want.items())
    # another checkpoint on the stored table reads everything again and adds only what is new
    add(spark, source, [("brand new", 1), ("first", 0)], PAIRS)
    ST.start_merge(stream_of(spark, source, PAIRS), out, f"{tmp_path}/second", buckets=8).awaitTermination()
    assert merged(spark, out) == sorted([*want.items(), ("brand new", 1)])


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    out = f"{tmp_path}/out"
    write = ST.merge_batch(out, "post_uri", "arrival", "r", 16)
    write(spark.createDataFrame([(f"k{i}", i) for i in range(200)], PAIRS), 0)
    mine = spark.createDataFrame([("k7",)], "post_uri string").select(SO.bucket_of("post_uri", 16)).head()[0]
    folders = glob.glob(f"{out}/run=r/batch=0/bucket=*")
    assert len(folders) == 16
    for folder in folders:
        if not folder.endswith(f"bucket={mine}"):
            for name in glob.glob(f"{folder}/*.parquet"):
                os.remove(f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc")
                with open(name, "wb") as f:
                    f.write(b"not a table")
    write(spark.createDataFrame([("k7", 1000)], PAIRS), 1)  # would fail if it opened another bucket
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        SO.read_store(spark, out, PAIRS, True).select("post_uri").collect()
    assert SO.read_store(spark, out, PAIRS, True).where(f"bucket = {mine}").where("post_uri = 'k7'").count() == 1


def test_compaction_keeps_rows_and_survives_a_crash(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for step in range(4):
        add(spark, source, [("a", step), (f"b{step}", step)], PAIRS)
    ST.start_merge(stream_of(spark, source, PAIRS), out, state, buckets=4).awaitTermination()
    run, before = ST.run_name(state), merged(spark, out)
    assert SO.valid_batches(spark, out) == {run: [0, 1, 2, 3]}
    kept = SO.read_store(spark, out, PAIRS, True, lambda r, b: b <= 2).drop("run", "batch").cache()
    kept.count()
    SO.write_batch(kept, out, run, -3, ["bucket"])  # a compaction that ended before the old folders went
    assert SO.valid_batches(spark, out) == {run: [-3, 3]} and merged(spark, out) == before
    os.makedirs(f"{out}/run={run}/batch=-9/_temporary")  # one that ended while writing
    assert merged(spark, out) == before
    os.rmdir(f"{out}/run={run}/batch=-9/_temporary")
    os.rmdir(f"{out}/run={run}/batch=-9")
    ST.compact_merged(spark, out, state, PAIRS)
    assert sorted(os.path.basename(f) for f in glob.glob(f"{out}/run=*/batch=*")) == ["batch=-3", "batch=3"] and merged(spark, out) == before
    replay = ST.merge_batch(out, "post_uri", "arrival", run, 4)
    replay(spark.createDataFrame([("a", 3), ("b3", 3)], PAIRS), 3)
    assert merged(spark, out) == before
    add(spark, source, [("c", 9), ("b0", 9)], PAIRS)
    ST.start_merge(stream_of(spark, source, PAIRS), out, state, buckets=4).awaitTermination()
    ST.compact_merged(spark, out, state, PAIRS, over=True)
    assert SO.valid_batches(spark, out) == {run: [-5]} and merged(spark, out) == sorted([*before, ("c", 9)])


def test_timeline_equals_the_batch_form(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    rng, posts = random.Random(3), []
    start = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    for _ in range(4):  # every file holds hours of the whole range, so most rows are late
        rows = [(start + dt.timedelta(hours=rng.choice((0, 1, 5, 30, 31)), minutes=rng.randrange(60)), rng.randrange(50), rng.choice(("Negative", "Neutral", "Positive", None)))
                for _ in range(25)]
        posts += rows
        add(spark, source, rows, HOURS)
        ST.start_hourly(stream_of(spark, source, HOURS), out, state).awaitTermination()
        ST.compact_hourly(spark, out, state)
    stamp = "%Y-%m-%dT%H:%M:%SZ"
    batch = spark.createDataFrame([(t.strftime(stamp), start.strftime(stamp), s, str(e), "0", "", None) for t, e, s in posts],
                                  "created_at string, collected_at string, sentiment_label string, like_count string, repost_count string, reply_count string, quote_count string")
    want = [r.asDict() for r in TL.hourly_timeline(batch).orderBy("hour").collect()]
    assert len(want) == 32 and sum(r["post_count"] == 0 for r in want) == 27
    assert [r.asDict() for r in ST.read_timeline(spark, out).orderBy("hour").collect()] == want
    ST.compact_hourly(spark, out, state, over=True)
    assert len(glob.glob(f"{out}/run=*/batch=*")) == 1 and [r.asDict() for r in ST.read_timeline(spark, out).orderBy("hour").collect()] == want


def test_an_empty_store(spark, tmp_path):
    assert merged(spark, f"{tmp_path}/none") == [] and ST.read_timeline(spark, f"{tmp_path}/none").count() == 0
    ST.compact_merged(spark, f"{tmp_path}/none", "state", PAIRS)


def test_first_ever_keeps_very_late_keys(spark, tmp_path):
    schema, source = "post_uri string, ts timestamp", f"{tmp_path}/in"
    for day in (20, 1, 20):
        add(spark, source, [(f"k{day}", dt.datetime(2024, 5, day, tzinfo=dt.timezone.utc)), ("always", dt.datetime(2024, 5, day, tzinfo=dt.timezone.utc))], schema)
        ST.start_to_table(ST.first_ever(stream_of(spark, source, schema), "post_uri"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r.post_uri for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()) == ["always", "k1", "k20"]
