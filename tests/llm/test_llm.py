"""The corpus operators on hand-made cases and against brute force."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chirrup.llm import decontaminate, fingerprints, labelled, language, licenses, mixture, near_dup, passages, quality, shards, toxicity
from chirrup.llm.common import Words, components, stored
from chirrup.llm.license_texts import MIT_GRANT

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, label int, h string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ba", "ke", "li", "mo", "nu", "sa", "tor", "vi")) for _ in range(r.randint(2, 4))) for _ in range(n))


LONG = prose("long", 30_000)
BASE = prose("base", 300)
ITEM = prose("item", 30)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a very long text, repeated rows, near copies, extra columns with internal names."""
    words = BASE.split()
    near = words[:]
    near[150] = "changed"
    rows = [
        (1, BASE, "en", "a"), (2, BASE.upper() + " !", "en", "a"), (3, " ".join(near), "en", None), (3, " ".join(near), "en", None),
        (4, None, None, "b"), (5, "", "en", "b"), (6, " \n ", None, None), (7, LONG, "fr", "b"), (None, prose("x", 40) + " " + ITEM, "fr", "a"),
        (8, "one", "en", "a"), (9, "?!", "en", "a"), (10, prose("y", 60) + " " + ITEM.replace(" ", ", ") + " " + prose("z", 60), "en", "c"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "n", 1, "h") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "one"), (3, None), (4, ""), (None, prose("no", 20))], "item_id long, text string")


def test_contained_items(spark, odd, empty):
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contained_items(odd, items(spark)).collect()}
    assert got == {(None, 1): 1.0, (10, 1): 1.0, (8, 2): 1.0}
    stay = decontaminate.drop_contaminated(odd, items(spark))
    assert stay.columns == odd.columns and stay.count() == odd.count() - 3
    assert decontaminate.contained_items(empty, items(spark)).count() == 0
    assert decontaminate.contained_items(odd, items(spark).limit(0)).count() == 0


def test_near_classes(odd, empty):
    rows = near_dup.near_classes(odd).collect()
    by = collections.defaultdict(set)
    for r in rows:
        if r.node is not None:
            by[r.class_id].add(r.doc_id)
    assert by[1] == {1, 2, 3} and sum(r.kept for r in rows if r.class_id == 1) == 1
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10]
    assert near_dup.keep_one(empty).count() == 0


def test_near_classes_keep_every_link_of_a_crowd(spark):
    # Crowds of copies at 0.5 to 0.9 of one another, most of them below 0.8.
    rows = []
    for c in range(12):
        base = prose(f"crowd{c}", 200).split()
        for i in range(60):
            r, words = random.Random(f"{c} {i}"), base[:]
            for at in r.sample(range(200), r.choice((2, 3, 4, 5, 5, 6, 6, 6))):
                words[at] = f"w{c}x{i}x{at}"
            rows.append((100 * c + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label = {r.doc_id: r.class_id for r in near_dup.near_classes(docs).collect()}
    bag = {i: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)} for i, t in rows}
    pairs = [(a, b) for a in bag for b in bag if a < b and a // 100 == b // 100 and len(bag[a] & bag[b]) >= 0.8 * len(bag[a] | bag[b])]
    assert len(pairs) > 100 and not [p for p in pairs if label[p[0]] != label[p[1]]]
    linked = {x for p in pairs for x in p}
    assert all(label[i] == i for i in label if i not in linked)


def test_links_of_slices_match_brute_force():
    import pandas as pd

    texts = ["a b c d e f " * n + prose(f"o{n}", 20 * n) for n in range(1, 6)] + ["one", prose("o3", 55), prose("o3", 60), "a b c d e f " * 60, "a b c d e f " * 70]
    bags = [collections.Counter(tuple(w[k : k + 5]) for w in [t.split()] for k in range(max(len(w) - 4, 1))) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(len(texts))]
    want = [sum((bags[i] & bags[j]).values()) / sum((bags[i] | bags[j]).values()) for i, j in pairs]
    assert near_dup.bag_overlap(pd.Series([texts[i] for i, _ in pairs]), pd.Series([texts[j] for _, j in pairs])).tolist() == want
    for slot in ([0] * len(texts), [i % 2 for i in range(len(texts))]):
        table = pa.table({"node": range(len(texts)), "label": range(len(texts)), "plain": texts, "slot": slot})
        found = {tuple(sorted(r.values())) for r in near_dup._links_of_slices(table).to_pylist()}
        assert found == {(i, j) for (i, j), v in zip(pairs, want) if i < j and v >= 0.8 and (slot[i] != slot[j] or not any(slot))} != set()


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 2**63, 60, dtype=np.uint64)
    wa, wb = rng.integers(0, 6, 60), rng.integers(0, 6, 60)
    h = np.concatenate((np.repeat(pool, wa), np.repeat(pool, wb)))
    doc = np.concatenate((np.zeros(wa.sum(), int), np.ones(wb.sum(), int)))
    sig = near_dup.signatures(doc, h, 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.03


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(20, 21), (21, 20)], "a long, b long")
    assert {r.node: r.label for r in components(edges).collect()} == {**{i: 1 for i in range(1, 13)}, 20: 20, 21: 20}


def test_wide_nodes_match_brute_force():
    h = np.random.default_rng(3).integers(1, 40, 300, dtype=np.uint64)
    h[[80, 81, 200]] = 0
    got = set(zip(*(x.tolist() for x in passages.wide_nodes(h, 12)), strict=True))
    want = set()
    for c in range(len(h)):
        if h[c]:
            lo = hi = c
            while lo > 0 and h[lo - 1] > h[c]:
                lo -= 1
            while hi + 1 < len(h) and h[hi + 1] >= h[c]:
                hi += 1
            if hi - lo + 1 >= 12:
                want.add((lo, c, hi))
    assert got == want


def test_repeated_passages(spark, odd, empty):
    part = prose("shared", 70)
    docs = spark.createDataFrame([(i, prose(f"p{i}", 80) + " " + part + " " + prose(f"q{i}", 80)) for i in range(5)] + [(9, prose("alone", 300))], "doc_id long, text string")
    rows = passages.repeated_passages(docs).collect()
    seen = {x for r in rows for x in (r.doc_id, r.partner_id)}
    assert seen == {0, 1, 2, 3, 4} and all(r.start_word <= 80 and r.end_word >= 149 for r in rows)
    kinds = {(r.doc_id, r.partner_id, r.kind) for r in passages.repeated_passages(odd).collect()}
    assert (2, 1, "copy") in kinds and any({3, 1} == {a, b} for a, b, k in kinds if k == "passage")
    assert passages.repeated_passages(empty).count() == 0


def test_mixture(spark, odd, empty):
    rows = mixture.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 3 for s, t in target.items())
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-6
    assert mixture.mix(empty).count() == 0 and mixture.mixed_documents(odd).columns == odd.columns
    same = spark.createDataFrame([(1, "a b c", "s")] * 50 + [(2, "a b", "t")], "doc_id long, text string, source string")
    assert {(r.source, r.taken) for r in mixture.mix(same).collect()} == {("t", 6), ("s", 2)}  # 146 words over 50 equal rows


def test_shards(spark, odd, empty):
    out = shards.shard(odd, 1000)
    assert out.columns == [*odd.columns, "shard", "shard_bytes", "shard_rows"] and out.count() == odd.count()
    for r in out.groupBy("shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("b"), F.count(F.lit(1)).alias("n"), F.max("shard_bytes").alias("s")).collect():
        assert r.b == r.s and (r.b <= 1000 or r.n == 1)
    same = shards.shard(spark.createDataFrame([(1, "x" * 300)] * 10, "doc_id long, text string"), 1000)
    assert sorted(r.shard_rows for r in same.collect()) == [1] + [3] * 9
    assert shards.shard(empty).count() == 0


def test_fingerprints(spark, odd, empty):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count() and fingerprints.fingerprints(empty).count() == 0
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[4] == prints[5] == prints[9]
    assert next(r for r in rows if r.doc_id == 1).near_next == 1.0
    texts = [prose(f"f{i}", 200) for i in range(40)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    import hashlib

    gaps = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[(i + 1) % 40][:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        a, b = collections.Counter(t.split()), collections.Counter(edited.split())
        gaps.append(got[i].near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.09


def test_language(spark, odd, empty):
    train = spark.createDataFrame([("the cat and the dog run with them", "en"), ("der hund und die katze laufen nicht", "de"), (None, "en"), ("x", None)], "text string, lang string")
    langs, logp = language.learn(train)
    assert langs == ["de", "en"]
    docs = spark.createDataFrame([(1, "the dog and the cat"), (2, "der hund und die katze"), (3, None), (4, "123 !"), (5, "")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.identify(docs, langs, logp, "doc_id").collect()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und"}
    assert language.identify(odd, *language.learn(empty), "doc_id").where("lang_pred != 'und'").count() == 0


def labelled_docs(spark):
    good = [(i, prose(f"g{i}", 60), 1) for i in range(60)]
    bad = [(100 + i, prose(f"b{i}", 60).upper().replace(" ", "!! "), 0) for i in range(60)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, y int")
    return rows.drop("y"), rows.select("doc_id", F.col("y").alias("quality"))


def test_quality(spark, odd):
    docs, labels = labelled_docs(spark)
    model = quality.train(*labelled.labelled_sample(docs, labels, "quality", labelled.fold(F.col("doc_id"), 5) != 0))
    held = quality.score(docs, model, "doc_id").join(labels, "doc_id").where(labelled.fold(F.col("doc_id"), 5) == 0).collect()
    assert all((r.score >= 0.5) == (r.quality == 1) for r in held)
    assert quality.score(odd, model, "doc_id").where("score between 0 and 1").count() == odd.count()
    flat = quality.train(*labelled.labelled_sample(docs, labels.limit(0), "quality", F.lit(True)))
    assert quality.score(odd, flat, "doc_id").where("score = 0.5").count() == odd.count()


def test_toxicity_ignores_group_names(spark, odd):
    rows = [(i, f"{prose(f't{i}', 20)} {'muslim ' if i % 3 else ''}moron", 1) for i in range(40)] + [(100 + i, prose(f"n{i}", 20), 0) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    sample, counts = labelled.labelled_sample(docs.drop("y"), docs.select("doc_id", F.col("y").alias("toxic")), "toxic", F.lit(True))
    plain, fair = toxicity.train(sample, counts, swap=0.0), toxicity.train(sample, counts, swap=100.0)
    muslim, other = toxicity.name_bucket("muslim"), toxicity.name_bucket("hindu")
    assert plain[muslim] - plain[other] > 0.1 and abs(fair[muslim] - fair[other]) < 0.3 * (plain[muslim] - plain[other])
    scores = {r.t: r.s for r in spark.createDataFrame([("ba ke moron",), ("ba ke li",)], "t string").select("t", toxicity.toxic_score(fair, F.col("t")).alias("s")).collect()}
    assert scores["ba ke moron"] > 0.5 > scores["ba ke li"]
    assert odd.where(toxicity.toxic_score(fair, F.col("text")) >= 0).count() == odd.count()


def test_licenses(spark, odd, empty):
    text = "Copyright (c) 2020 Someone\n\n" + MIT_GRANT.replace("sublicense", "sub-license").upper()
    docs = spark.createDataFrame([(1, text), (2, "hello\nReleased under the MIT Licence\nbye"), (3, None), (4, "All rights reserved.")], "doc_id long, text string")
    assert {(r.doc_id, r.license_id, r.scope, r.matches) for r in licenses.scan(docs).collect()} == {(1, "MIT", "text", 1), (2, "MIT", "line", 1)}
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0


def test_words():
    w = Words(pa.array(["a b", "", "b a b", None]))
    assert w.doc.tolist() == [0, 0, 2, 2, 2]
    every = np.arange(5)
    h = w.hashed(every, every)
    assert h[0] == h[3] and h[1] == h[2] == h[4] and h[0] != h[1]


def test_pipeline(spark, folder):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, folder).cache()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert out.columns == [*docs.columns, "shard", "shard_bytes", "shard_rows"]
    kept = {r.doc_id: r.text for r in out.select("doc_id", "text").distinct().collect()}
    grams = lambda t, n=5: {tuple(w[i : i + n]) for w in [re.findall(r"\w+", t.lower())] for i in range(len(w) - n + 1)}
    bench = [grams(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    own = {i: grams(t) for i, t in kept.items()}
    assert not [i for i, g in own.items() for b in bench if len(g & b) >= 0.8 * len(b)]
    by = collections.defaultdict(set)
    for i, g in own.items():
        for x in g:
            by[x].add(i)
    pairs = {(a, b) for s in by.values() if 1 < len(s) < 30 for a in s for b in s if a < b}
    assert not [p for p in pairs if len(own[p[0]] & own[p[1]]) > 0.85 * len(own[p[0]] | own[p[1]])]


def shares(rows, a, b, places):
    """Whether a row of the pair covers the word places on both sides."""
    (s, e), (p, q) = places
    return any((r.doc_id, r.partner_id) == (x, y) and r.start_word <= i and j <= r.end_word and r.partner_start <= k and m <= r.partner_end
               for r in rows for x, y, i, j, k, m in ((a, b, s, e, p, q), (b, a, p, q, s, e)))


def test_repeated_passages_beside_a_frequent_line(spark):
    line = prose("line", 36)
    rows = [(i, prose(f"r{i}", 60) + " " + line + " " + prose(f"s{i}", 60)) for i in range(200)]
    for i in range(30):  # pairs that share 14 words more than the line
        more = line + " " + prose(f"m{i}", 14)
        rows += [(1000 + 2 * i + j, prose(f"u{i}{j}", 60) + " " + more + " " + prose(f"v{i}{j}", 60)) for j in (0, 1)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(shares(found, 1000 + 2 * i, 1001 + 2 * i, ((60, 109), (60, 109))) for i in range(30))
    assert {(r.doc_id // 2, r.partner_id // 2) for r in found} == {(500 + i, 500 + i) for i in range(30)}


def test_repeated_passages_with_a_repeated_line(spark):
    rows = []
    for i in range(20):  # the line stands alone first, in the passage later; the passages differ in one word
        line, rest, end = prose(f"l{i}", 40), prose(f"e{i}", 8), prose(f"f{i}", 11)
        rows += [(2 * i, " ".join((prose(f"a{i}", 60), line, prose(f"b{i}", 60), line, rest, "one", end, prose(f"c{i}", 60)))),
                 (2 * i + 1, " ".join((prose(f"d{i}", 60), line, rest, "two", end, prose(f"g{i}", 60))))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(shares(found, 2 * i, 2 * i + 1, ((160, 219), (60, 119))) for i in range(20))


def test_fingerprints_of_skewed_weights(spark):
    # One word 500 times in front, ten others behind, which the edit replaces together with half of the copies.
    texts = ["the " * 500 + prose(f"k{i}", 20 + 10 * (i % 5)) for i in range(40)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    gaps = []
    for i in range(40):
        a, b = collections.Counter(texts[i].split()), collections.Counter(texts[(i + 1) % 40].split())
        gaps.append(got[i].near_next - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.09


def test_toxicity_of_swapped_sentences(spark):
    rows = [(i, f"{prose(f't{i}', 20)} {'muslim ' if i % 3 else ''}moron", 1) for i in range(40)] + [(100 + i, prose(f"n{i}", 20), 0) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    sample, counts = labelled.labelled_sample(docs.drop("y"), docs.select("doc_id", F.col("y").alias("toxic")), "toxic", F.lit(True))
    said = spark.createDataFrame([(n, f"ba ke {n} li mo") for n in ("muslim", "hindu", "sikh")], "n string, t string")

    def spread(swap):
        p = np.array([r.s for r in said.select(toxicity.toxic_score(toxicity.train(sample, counts, swap=swap), F.col("t")).alias("s")).collect()])
        return np.ptp(np.log(p / (1 - p)))

    assert spread(100.0) < 0.15 * spread(0.0)


def test_full_license_texts_and_notices(spark):
    from chirrup.llm.license_texts import BSD_3, FULL, NOTICES

    rows = [(i, n, t, "text") for i, (n, t) in enumerate((*FULL, ("BSD-3-Clause", BSD_3)))]
    rows += [(100 + i, n, f"hello\n{t}\nbye", "line") for i, (n, t) in enumerate(NOTICES)]
    got = {(r.doc_id, r.license_id, r.scope) for r in licenses.scan(spark.createDataFrame([(i, t) for i, _, t, _ in rows], "doc_id long, text string")).collect()}
    assert {(i, n, scope) for i, n, _, scope in rows} <= got


def test_licenses_are_found_however_they_are_wrapped(spark):
    import textwrap

    from chirrup.llm.license_texts import BSD_2, BSD_3, FULL, ISC_GRANT, ZLIB

    texts = [*FULL, ("MIT", MIT_GRANT), ("ISC", ISC_GRANT), ("BSD-2-Clause", BSD_2), ("BSD-3-Clause", BSD_3), ("Zlib", ZLIB)]
    rows = []
    for name, text in texts:
        for width in (40, 60, 66, 100):
            wrapped = "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in text.split("\n\n"))
            rows.append((len(rows), name, wrapped))
            rows.append((len(rows), name, " ".join(wrapped.split())))
        rows.append((len(rows), name, f"Copyright (c) 2019-2021, Some One <a@b.c>\n# © Another\nAll rights reserved.\n\n{text}"))
    df = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.matches) for r in licenses.scan(df).where("scope = 'text'").collect()}
    assert got == {i: (name, 1) for i, name, _ in rows}


def test_only_notices_are_taken_out(spark):
    lines = ["Copyright (c) 2020 X", "copyright 1999 Y", " * (C) Z", "© W", "All rights reserved.", "COPYRIGHT HOLDERS AND CONTRIBUTORS BE LIABLE",
             "copyright notice, this list of conditions", "all rights reserved under this license remain", "the copyright (c) of 2020", "Copyright [yyyy] [name]"]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    assert [r.t for r in df.where(licenses.without_notices(F.col("t")) == F.col("t")).collect()] == lines[5:]


@pytest.mark.parametrize("line_words, more_words", [(46, 14), (44, 26), (40, 12)])
def test_similar_passages_beside_a_frequent_line(spark, line_words, more_words):
    line = prose("often", line_words)
    rows = [(i, prose(f"r{i}", 60) + " " + line + " " + prose(f"s{i}", 60)) for i in range(400)]
    for i in range(60):  # pairs that share more than the line; one word differs
        more = prose(f"m{i}", more_words).split()
        for j in (0, 1):
            more[i % 10] = f"other{j}"
            rows.append((1000 + 2 * i + j, " ".join((prose(f"u{i}{j}", 60), line, *more, prose(f"v{i}{j}", 60)))))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {tuple(sorted((r.doc_id, r.partner_id))) for r in found}
    assert [i for i in range(60) if (1000 + 2 * i, 1001 + 2 * i) not in pairs] == []


def test_similar_passages_against_all_pairs():
    # Two frequent lines in all mixtures, with own words between them; every similar pair is met or both meet one text in between.
    r = random.Random(5)
    lines = [prose(f"l{i}", 30).split() for i in range(2)]
    texts = []
    for i in range(60):
        parts = [prose(f"o{r.randrange(12)}", 8).split() if r.random() < 0.6 else prose(f"own{i}", 3).split(), lines[1]]
        texts.append(" ".join([*prose(f"b{i}", 50).split(), *lines[0], *(r.choice((parts, parts[:1], [])) and sum(parts, [])), *prose(f"e{i}", 50).split()]))
    h = [Words(pa.array([t])).shingles()[1] for t in texts]
    anchor = Words(pa.array([" ".join(lines[0])])).shingles()[1][12]
    place = [int(np.flatnonzero(x == anchor)[0]) for x in h]
    room = passages.ROOM
    around = np.zeros((60, 2 * room + 1), np.uint32)
    for i, (x, c) in enumerate(zip(h, place)):
        part = np.maximum((x[max(c - room, 0) : c + room + 1] >> np.uint64(32)).astype(np.uint32), 1)
        start = room - min(c, room)
        around[i, start : start + len(part)] = part
    similar = {(i, j) for i in range(60) for j in range(i + 1, 60) if passages.verified_spans(h[i], h[j], [(place[i], place[j])])}
    linked = {(int(i), int(j)) for i, j in zip(*passages.met_pairs(np.arange(60), around))} & similar
    near = collections.defaultdict(set)
    for i, j in linked:
        near[i].add(j)
        near[j].add(i)
    assert similar and all((i, j) in linked or near[i] & near[j] for i, j in similar)


def test_crowds_beyond_their_rounds(monkeypatch):
    # Near copies with edits in many mixtures: rounds and all pairs at once give the same near pairs.
    rng = np.random.default_rng(2)
    base = rng.integers(1, 2**32, 2 * passages.ROOM + 1, dtype=np.uint32)
    around = np.tile(base, (40, 1))
    for row in around:
        at = np.setdiff1d(rng.integers(0, len(base), 60), [passages.ROOM])
        row[at] = base[at] // 2 + rng.integers(0, 2, len(at), dtype=np.uint32)
    want = set(zip(*(x.tolist() for x in passages.met_pairs(np.arange(40), around))))
    monkeypatch.setattr(passages, "MANY", 4)
    assert set(zip(*(x.tolist() for x in passages.met_pairs(np.arange(40), around)))) == want != set()


@pytest.mark.parametrize("step, names", [(near_dup._band_keys, ("doc_id", "node", "plain"))])
def test_arrays_of_a_batch_of_texts_are_bounded(step, names):
    r = random.Random(7)
    texts = [" ".join(f"w{r.randrange(5000)}" for _ in range(400)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(range(1500)), pa.array(texts)], list(names))
    for _ in step(iter([batch.slice(0, 10)])):  # tables of the module
        pass
    tracemalloc.start()
    for _ in step(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_stored_gives_python_few_rows_at_a_time(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(b)])], ["n"])

    seen = stored(spark.range(0, 50, numPartitions=1).mapInArrow(sizes, "n long"), "batches", 8)
    assert [r.n for r in seen.collect()] == [8] * 6 + [2] and spark.conf.get(name) == usual
