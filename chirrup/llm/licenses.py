"""License scans by canonical digests: whole texts and whole lines against known license wordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chirrup.llm.license_texts import KNOWN

# Equivalent spellings, applied to whole words of the normalised text (fixed values).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("copyright owner", "copyright holder"),
    ("cancelled", "canceled"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("licence", "license"),
    ("licences", "licenses"), ("licenced", "licensed"), ("merchantability and fitness", "merchantability fitness"),
    ("noncommercial", "non commercial"), ("organisation", "organization"), ("per cent", "percent"),
    ("sub license", "sublicense"), ("sublicence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("https", "http"), ("v3", "version 3"), ("v2", "version 2"),
)


# A line that is a copyright notice: it begins as one and names a year or carries the sign, or it only reserves rights.
# A line of running text that begins with the word is none of these, however the text is wrapped.
NOTICE = (r"(?mi)^[^\p{L}\p{N}\n(©]*(?:(?=[^\n]*(?:\(c\)|©|\b(?:19|20)\d\d\b))(?:copyright\b|\(c\)|©)[^\n]*"
          r"|all rights reserved[^\p{L}\p{N}\n]*)$")


def canonical(text: Column) -> Column:
    """Lower case, line breaks and punctuation as one space, one spelling for equivalents."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "), F.lit(" "))
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(words)


def without_notices(text: Column) -> Column:
    """The text without its copyright lines."""
    return F.regexp_replace(text, NOTICE, " ")


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> list[tuple[str, str]]:
    """(digest, license_id) of the known wordings, with and without their copyright lines; the caller's list bounds its size."""
    rows = spark.createDataFrame(list(known), "license_id string, wording string")
    forms = F.array_distinct(F.array(canonical(F.col("wording")), canonical(without_notices(F.col("wording")))))
    made = rows.select("license_id", F.explode(forms).alias("form")).where("form <> ''").select(F.sha2("form", 256).alias("digest"), "license_id")
    return sorted((r.digest, r.license_id) for r in made.distinct().collect())


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """One row per distinct (doc_id, license_id, scope) with `matches`.

    scope `text`: the document's entire text is the license, however its lines
    are wrapped and with or without copyright lines. scope `line`: an
    entire line of a longer text is a license wording; `matches` counts such
    lines over all rows of the id. Null, empty and all-copyright texts match
    nothing. Null ids form one group.
    """
    spark = docs.sparkSession
    listed = known_digests(spark, known)
    digests = F.broadcast(spark.createDataFrame(listed, "digest string, license_id string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x)) > 0)
    units = docs.select("doc_id", text.alias("text"), lines.alias("lines"))
    whole = units.select("doc_id", F.lit("text").alias("scope"), F.col("text").alias("unit"))
    parts = units.where(F.size("lines") > 1).select("doc_id", F.lit("line").alias("scope"), F.explode("lines").alias("unit"))
    # A unit counts once: as it is if that is known, else without its copyright lines, which few units have.
    unit = F.col("unit")
    bare = F.when(unit.rlike(NOTICE), F.sha2(canonical(without_notices(unit)), 256)).otherwise(F.lit(""))
    as_it_is = F.array(F.sha2(canonical(unit), 256))
    chosen = F.get(F.transform(as_it_is, lambda d: F.when(d.isin([x for x, _ in listed]), d).otherwise(bare)), F.lit(0))
    # Never null, so the optimizer adds no null filter, which would canonicalise every unit a second time.
    return (whole.union(parts).select("doc_id", "scope", F.coalesce(chosen, F.lit("")).alias("digest"))
            .join(digests, "digest").groupBy("doc_id", "license_id", "scope").agg(F.count(F.lit(1)).alias("matches")))
