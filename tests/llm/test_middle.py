"""Fill-in-the-middle against a plain slicing version, and its exact round trip."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from chirrup.llm import middle

SCHEMA = "doc_id long, text string, output string, form string, n string"


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    alphabet = "abcXYZ  ,.\néß中\U0001f600<>PSM"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    long = "".join(rng.choice(("word ", "été, ", "\U0001f600", "x")) for _ in range(900_000))
    return [*made, None, "", "a", "é", "<P>", "a<S>b", "tail<M>", "<", "<S", "S>", long, "\u0000\u0000x", "same", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, "mine", "yours", "z") for i, t in enumerate(texts())] + [(None, "null key text", None, None, None), (5, "again", "", "", ""), (5, "again", "", "", "")]
    return spark.createDataFrame(data, SCHEMA).repartition(3), data


def test_equals_slicing_and_comes_back(rows):
    df, data = rows
    made = df.withColumn("m", middle.fill_in_middle(F.col("text"), F.col("doc_id")))
    assert made.columns == [*df.columns, "m"]
    back = made.select("doc_id", "text", "m.*", middle.restore(F.col("m.output"), F.col("m.form")).alias("back")).collect()
    assert len(back) == len(data)
    seen = set()
    for r in back:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
        seen.add(r.form)
    assert seen == {"plain", "psm", "spm"}


def test_cuts_across_blocks(monkeypatch):
    monkeypatch.setattr(middle, "_BLOCK", 7)
    for i, t in enumerate(texts()[:310]):
        got = middle._transformed((t or "").encode(), str(i), middle.MiddleParams())
        assert (got["n"], got["form"], got["prefix_chars"], got["middle_chars"], got["output"].decode()) == brute(i, t)
        assert middle.restored(got["output"], got["form"]).decode() == (t or "")


def test_rotation_is_its_own_inverse():
    for start, turn, end in ((0, 0, 9), (0, 9, 9), (2, 5, 9), (3, 4, 4), (0, 1, 10)):
        buffer = bytearray(b"0123456789")
        middle.rotate(buffer, start, turn, end)
        assert buffer == b"0123456789"[:start] + b"0123456789"[turn:end] + b"0123456789"[start:turn] + b"0123456789"[end:]
        middle.rotate(buffer, start, start + end - turn, end)
        assert buffer == b"0123456789"


def test_restore_rejects_foreign_outputs():
    for output, form in ((b"no sentinels", "psm"), (b"<M>a<S>b", "psm"), (b"<P>a<S>b", "spm"), (b"x", "other")):
        with pytest.raises(ValueError):
            middle.restored(output, form)


def test_nulls_and_empty_table(spark, rows):
    df, _ = rows
    none = df.limit(0).select(middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("m")).select("m.*")
    assert none.count() == 0 and none.columns == ["n", "form", "prefix_chars", "middle_chars", "output"]
    nulls = spark.createDataFrame([(None, "psm"), ("x", None)], "o string, f string")
    assert [r.b for r in nulls.select(middle.restore(F.col("o"), F.col("f")).alias("b")).collect()] == [None, None]
