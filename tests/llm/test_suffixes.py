"""Suffix arrays, common prefixes and the removal of repeated bytes against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chirrup.llm import suffixes

SCHEMA = "doc_id long, text string, kept string, spans string, row int, k1 long, bucket long"


def noise(seed, n, alphabet="abcdefgh é\n\u0000"):
    rng = random.Random(str(seed))
    return "".join(rng.choice(alphabet) for _ in range(n))


PASSAGE = noise("passage", 260)
LINE = noise("line", 90)


def texts():
    rng = random.Random(9)
    copies = noise("copy", 900)
    near = copies[:400] + "X" + copies[401:]
    shared = [noise(("a", i), rng.randint(0, 400)) + PASSAGE + noise(("b", i), rng.randint(0, 400)) for i in range(30)]
    lines = [noise(("c", i), 200) + LINE + noise(("d", i), 200) for i in range(20)]
    wide = "\U0001f600中" * 60
    return [copies, copies, near, copies[100:300], copies[:199], *shared, *lines, "a" * 1000, "b" * 199, "c" * 200, "d" * 201, "ab" * 400, wide, wide + "x",
            None, "", "short", PASSAGE + PASSAGE, noise("alone", 5000), noise("long", 1_100_000) + PASSAGE, "z" * 300 + "\u0000" * 300 + "z" * 300]


def brute(values, span=200):
    raw = [(t or "").encode() for t in values]
    seen = collections.Counter(hash(r[i : i + span]) for r in raw for i in range(len(r) - span + 1))
    out = []
    for r in raw:
        spans = []
        for i in range(len(r) - span + 1):
            if seen[hash(r[i : i + span])] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + span
                else:
                    spans.append([i, i + span])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + r[at:a], b
        kept += r[at:]
        out.append((len(r), len(r) - len(kept), tuple(map(tuple, spans)), hashlib.sha256(kept).hexdigest()))
    return out


def found(df, **options):
    made = suffixes.remove_repeats(df, **options)
    assert made.columns == ["row", "spans", "n_bytes", "n_removed", "kept"]
    rows = made.select("row.doc_id", "spans", "n_bytes", "n_removed", F.sha2("kept", 256).alias("h")).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.stop) for s in r.spans), r.h) for r in rows), key=str)


def frame(spark, values):
    return spark.createDataFrame([(i if i != 3 else None, t, "k", "s", 1, 2, 3) for i, t in enumerate(values)], SCHEMA).repartition(3)


@pytest.mark.parametrize("shard_bytes", (700, 3000, suffixes.SHARD_BYTES))
def test_equals_brute_force(spark, shard_bytes):
    values = texts()
    want = sorted(((i if i != 3 else None, *r) for i, r in enumerate(brute(values))), key=str)
    assert found(frame(spark, values), shard_bytes=shard_bytes) == want
    assert sum(r[2] for r in want) > 10_000


def test_another_span_and_empty_table(spark):
    values = [t for t in texts() if len(t or "") < 10_000]
    want = sorted(((i if i != 3 else None, *r) for i, r in enumerate(brute(values, 90))), key=str)
    assert found(frame(spark, values), span=90) == want
    assert found(frame(spark, values).limit(0)) == []
    assert [r[2:4] for r in found(frame(spark, ["", None, "only one"]))] == [(0, ())] * 3


@pytest.mark.parametrize("block, stretch", ((1 << 20, 1 << 12), (300, 50)))
def test_every_string_is_in_one_stretch_of_its_key(monkeypatch, block, stretch):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "STRETCH", stretch)
    for group in ([t for t in texts() if t and 200 <= len(t) < 6000], [noise("one", 3000)], ["a" * 2500]):
        raw = [t.encode() for t in group]
        at = pa.array(range(len(raw)), pa.int64())
        batches = list(suffixes._keyed(200)([pa.RecordBatch.from_arrays([at, at, pa.array(group)], ["k1", "k2", "text"])]))
        starts, key, body, places = collections.Counter(), {}, {}, collections.Counter()
        for r in pa.Table.from_batches(batches).to_pylist():
            places[r["bucket"]] += r["places"]
            assert body.setdefault((r["bucket"], r["cid"]), raw[r["k1"]][r["at"] : r["at"] + r["windows"] + 199]) == raw[r["k1"]][r["at"] : r["at"] + r["windows"] + 199]
            for i in range(r["at"], r["at"] + r["windows"]):
                starts[r["k1"], i] += 1
                assert key.setdefault(raw[r["k1"]][i : i + 200], r["bucket"]) == r["bucket"]
        assert set(starts.values()) == {1} and len(starts) == sum(len(x) - 199 for x in raw)
        seen = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
        assert all(places[key[s]] > 1 for s, n in seen.items() if n > 1)


@pytest.mark.parametrize("alphabet", (b"a", b"ab\x00", bytes(range(256))))
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(1)
    raw = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(30)]
    raw += raw[:5]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    for depth in (5, 20, 100):
        sa, rank = suffixes.suffix_array(data, offs, depth)
        suffix = [bytes(data[i : offs[np.searchsorted(offs, i, "right")]]) for i in sa]
        assert sorted(sa) == list(range(len(data)))
        assert [s[:depth] for s in suffix] == sorted(s[:depth] for s in suffix)
        shared = suffixes.common_prefixes(data, offs, sa, rank, depth)
        for j in range(1, len(sa)):
            if len(suffix[j]) >= depth:
                same = next((k for k in range(depth) if k >= len(suffix[j - 1]) or suffix[j - 1][k] != suffix[j][k]), depth)
                assert shared[j] == same
