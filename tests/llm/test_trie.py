"""The burst trie against nested dictionaries, for containers of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chirrup.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, path string, depth int, n_convs long"


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 60), *range(120, 180), 305, 399, 1000]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("a", "é\U0001f600", "", None, "long text"))))
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2100) for t in range(4)]  # copies of one conversation
    rows += [(c, t, "user", f"stem {t}") for c in range(3000, 3040) for t in range(30)]  # a long shared stem, then one turn each
    rows += [(c, 30, "user", f"end {c % 7}") for c in range(3001, 3040)]
    rows += [(4000 + c, t, "user", f"comb {t}") for c in range(12) for t in range(c + 1)]  # every path is a prefix of the next
    rows += [(7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, None, "user", "null first"), (None, 0, "user", "nobody's"), (402, 0, "x", "y")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "p", 1, 2) for r in rows], SCHEMA).repartition(3)


def brute(rows, shared=True):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), (r, x)))
    own = {c: [x for _, _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, p in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        built[c] = own.get(c - c % 100, [])[:h] + p[h:]
    members = defaultdict(list)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out = []

    def walk(k):
        leaves, saved = 0, 0
        for child in kids[k]:
            a, b = walk(child)
            leaves, saved = leaves + a, saved + b
        leaves = leaves or 1
        saved += (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
        ends = ",".join(str(c) for c in sorted(members[k]) if len(built[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        walk(())
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("most", (1, 40, 400, 100_000))
def test_equals_nested_dictionaries(spark, most):
    rows = conversations()
    every = trie.with_shared_start(trie.paths(frame(spark, rows)), 100, 5, F.crc32(F.col("conv_id").cast("string")))
    assert found(trie.prefix_trie(every, most)) == brute(rows)


def test_paths_as_they_are_and_node_keys(spark):
    rows = [(c, t, "user", f"{c % 3}-{t}") for c in range(30) for t in range(5)]
    nodes = trie.prefix_trie(trie.paths(frame(spark, rows)), 10)
    assert found(nodes) == brute(rows, shared=False)
    keys = {r.node: r.parent for r in nodes.collect()}
    assert len(keys) == 16 and sum(p is None for p in keys.values()) == 1 and all(p in keys for p in keys.values() if p is not None)


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(trie.paths(frame(spark, conversations()).limit(0))).count() == 0
    rows = [(c, 0, "u", "t") for c in (101, 102, 103, 104)]  # the first of the span is missing, so most lose their only turn
    every = trie.with_shared_start(trie.paths(frame(spark, rows)), 100, 5, F.crc32(F.col("conv_id").cast("string")))
    assert found(trie.prefix_trie(every)) == brute(rows)


def test_ends_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "_IDS_PER_CHUNK", 3)
    members = spark.createDataFrame([(b"a", i) for i in range(20, 0, -1)] + [(b"b", 7)], "node binary, conv_id long").repartition(4)
    got = {bytes(r.node): r.ends for r in trie.ends_digest(members).collect()}
    assert got == {b"a": hashlib.sha256(",".join(map(str, range(1, 21))).encode()).hexdigest(), b"b": hashlib.sha256(b"7").hexdigest()}
