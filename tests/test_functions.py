"""Column functions against plain Python on literal rows."""

import html
import re

import pytest
from pyspark.sql import functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C, text as X
from chirrup.operators import topics as TP


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).head()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("see you at the caf\\u00e9 \\u2019round", "see you at the café ’round"),
        ("Bread &amp; &quot;butter&quot;", 'Bread & "butter"'),
        ("twice &amp;quot;coded&amp;quot;", 'twice "coded"'),
        ("@ann replied to @bob_2", "@user replied to @user"),
        ("look: https://a.example/x?y=1 and www.b.example", "look: <url> and <url>"),
        ("  many \t blanks\nnext  ", "many blanks\nnext"),
        ("\\ud83d\\ude00 smile", "😀 smile"),
        ("lone \\ud83d half", "lone � half"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, X.clean_text("v"), raw) == clean


def test_restore_text_decodes_once(spark):
    assert one(spark, X.restore_text("v"), " &amp;lt; ") == html.unescape("&amp;lt;")
    assert one(spark, X.restore_text("v"), "   ") is None


@pytest.mark.parametrize("raw", ["NULL", " nan ", "None", "n/a", "NA", "", "  "])
def test_placeholders(spark, raw):
    assert one(spark, C.normalize_missing("v"), raw) is None
    assert one(spark, C.to_long_or_null("v"), raw) is None


@pytest.mark.parametrize(
    "raw, kind, parsed",
    [
        ("1714557600", "unix_epoch", "2024-05-01 10:00:00"),
        ("2024-05-01T10:00:00", "iso_8601", "2024-05-01 10:00:00"),
        (" 03-06-2024 ", "dd_mm_yyyy", "2024-06-03 00:00:00"),
        ("31-02-2024", "dd_mm_yyyy", "None"),
        ("yesterday", "unknown", "None"),
    ],
)
def test_timestamps(spark, raw, kind, parsed):
    assert one(spark, C.timestamp_format("v"), raw) == kind
    assert str(one(spark, C.parse_timestamp("v"), raw)) == parsed


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert str(one(spark, C.parse_timestamp("v"), "1714557600")) == "2024-05-01 10:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_instants(spark):
    rows = [("2024-01-01T01:00:00+02:00",), ("2023-12-31T23:00:00Z",), ("",), ("soon",)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(F.unix_timestamp(C.parse_instant("v"))).collect()]
    assert got[0] == got[1] and got[2] is None and got[3] is None


def test_engagement_forms(spark):
    rows = [(1, None, 3), (None, None, None), (4, 5, 6)]
    df = spark.createDataFrame(rows, "likes long, shares long, comments long")
    assert [r[0] for r in df.select(C.engagement_known("likes", "shares", "comments")).collect()] == [4, None, 15]
    text = spark.createDataFrame([("1", ""), ("2", "x"), (None, "3")], "a string, b string")
    assert [r[0] for r in text.select(C.engagement_counters("a", "b")).collect()] == [1, 0, 3]


def python_char_ngrams(text, low, high):
    out = []
    for word in text.lower().split():
        padded = f" {word} "
        for n in range(low, high + 1):
            if n >= len(padded):
                out.append(padded)
                break
            out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
    return out


@pytest.mark.parametrize("text", ["a", "ab Cde", "Größe it's über", "", "x  longerword"])
def test_char_ngrams(spark, text):
    assert sorted(one(spark, X.char_ngrams("v", 3, 5), text)) == sorted(python_char_ngrams(text, 3, 5))


@pytest.mark.parametrize("text", ["Don't stop-it now#tag d'été café x1 a", "naïve l'#b #c", "word- 'quoted' under_score"])
def test_tokenisers_follow_unicode_words(spark, text):
    social = re.findall(r"\b[A-Za-z#][A-Za-z0-9'#_-]{1,}\b", text.lower())
    assert one(spark, X.social_tokens("v"), text) == social
    assert one(spark, X.word_tokens("v"), text) == re.findall(r"\b\w\w+\b", text.lower())
    assert one(spark, X.hashtags("v"), text) == re.findall(r"#(\w+)", text)


def test_topic_cleaning(spark):
    text = "9to5mac says @bob: #iPhone costs 999 at https://x.example <url> &amp; it is ok"
    assert one(spark, X.clean_for_topics("v"), text) == "9to5mac says : iPhone costs"
    assert one(spark, X.topic_tokens("v"), "9to5mac") == ["to5mac"]


def test_word_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(X.word_ngrams(F.col("t"), 1, 2)).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_counting_inside_a_row(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "t array<string>")
    got = [[(x["term"], x["tf"]) for x in r["counted"]] for r in TP.count_terms(df, F.col("t")).collect()]
    assert got == [[("a", 1), ("b", 2)], []]


def test_entities(spark):
    def found(t):
        return one(spark, X.entities("v"), t)

    assert found("Meta Quest and apple") == ["Apple"]
    assert "Meta" in found("meta glasses")
    assert found("the m5 chip") == [] and found("the M5 chip") == ["M5"]
    assert found("iphone17 here") == ["iPhone 17"]
    assert found("Gurman writes") == ["Mark Gurman"]
    assert len(P.ENTITY_NAMES) == 33


@pytest.mark.parametrize(
    "text, hit",
    [("new iPhone", True), ("iphones", False), ("ios27 beta", True), ("apple  event", True), ("apple pie", False), ("A19", True)],
)
def test_product_filter(spark, text, hit):
    assert one(spark, X.mentions_product("v"), text) is hit


def test_product_filter_knows_every_phrase(spark):
    yes = ("iphone 16", "iPhone17", "iphone  18", "iphoneduo", "iphone duo", "appleiphone", "apple iphone", "iphone pro", "iphone launch", "ios26", "iOS 27",
           "AlarmKit", "iphone preorder", "iphone order", "iphone release", "apple launch", "Apple  event", "apple announcement", "iphone camera", "iphone battery",
           "iphone price", "iphone review", "iphone chip", "iphone feature", "iphone upgrade", "iphone buy", "iphone unbox", "iphone teardown", "apple silicon", "A19", "a20", "iphone")
    no = ("iphone15", "iphones", "myiphone", "appleiphone17", "ios 25", "apple pie", "applelaunch", "a190", "ba20", "alarmkits", "")
    df = spark.createDataFrame([(t,) for t in [*yes, *no]], "t string")
    got = {r.t for r in df.where(X.mentions_product("t")).collect()}
    assert got == set(yes)
    around = df.select(F.concat(F.lit("so, "), "t", F.lit("!")).alias("t"))
    assert around.where(X.mentions_product("t")).count() == len(yes)


def test_stop_words_are_the_expected_list(spark):
    from chirrup.plans import check_sql

    assert set(X.english_stop_words()) == set(check_sql.STOP_WORDS)
