"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement.

Each document draws an exponential key divided by its quality weight; the
documents of a source in ascending key order are a weighted random permutation.
A source takes as many complete epochs as its target holds, then the documents
at the head of that order until the prefix sum of their sizes reaches the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.llm.common import broadcast_if_small
from chirrup.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
PATTERN = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
SLICES = 4096  # key slices per source; only the slice at the cut is sorted


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight: share of letters in the text, at least 0.01."""
    n = F.char_length(text)
    letters = n - F.char_length(F.regexp_replace(text, r"\p{L}", ""))
    return F.when(n > 0, F.greatest(letters / n, F.lit(0.01))).otherwise(F.lit(0.01))


def draw(doc_id: Column, weight: Column, seed: str = "mix") -> Column:
    """-ln(U) / weight with U in (0, 1) from a digest of the id, so reruns agree."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return -F.ln((bits.cast("double") + 0.5) / float(1 << 52)) / weight


def source_targets(sources: DataFrame, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """`target` for each row of sources(source, source_size, weight): shares by weight, capped.

    The total of all sizes is shared by weight; a target above `most_epochs`
    times its source stops there and the excess is shared again by weight until
    none is above. That ends with min(cap, level * weight) for one common level,
    found from prefix sums over the sources in order of cap / weight.
    """
    cap = F.col("source_size") * F.lit(float(most_epochs))
    order = Window.orderBy(cap / F.col("weight"), F.struct(F.col("source").isNull(), "source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    stepped = sources.withColumn("_level", level)
    common = F.max(F.when(F.col("_level") <= cap / F.col("weight"), F.col("_level"))).over(everything)
    return stepped.withColumn("target", F.least(cap, F.coalesce(common, F.lit(0.0)) * F.col("weight"))).drop("_level")


def mix(docs: DataFrame, quality: Column | None = None, pattern: tuple[float, ...] = PATTERN,
        most_epochs: int = MOST_EPOCHS, slices: int = SLICES) -> DataFrame:
    """One row per document: doc_id, source, size, draw, source_size, target, epochs, taken.

    Sources in code point order, null last, get the weights of `pattern`,
    repeating. `taken` counts words: `epochs` times the size, plus the size of
    documents before the cut of the order; the document at the cut gives the
    words that are left, and identical rows at the cut share them. Null and
    empty texts have size 0 and take nothing; no document exceeds `most_epochs`
    times its size. Nothing is sorted but the one key slice that holds the cut.
    """
    weight = letter_share(F.col("text")) if quality is None else quality
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                   draw(F.col("doc_id"), weight).alias("draw")))
    plans = mix_plan(rows, pattern, most_epochs, slices)
    p = plans.select(*[F.col(c).alias(f"p_{c}") for c in plans.columns])
    joined = rows.join(broadcast_if_small(p, 128), F.col("source").eqNullSafe(F.col("p_source")))
    return joined.select("doc_id", "source", "size", "draw", F.col("p_source_size").alias("source_size"),
                         F.col("p_target").alias("target"), F.col("p_epochs").alias("epochs"), taken_words("p_").alias("taken"))


def taken_words(p: str = "p_") -> Column:
    """Words taken of a row (size, draw, doc_id) under its source's plan (columns with prefix `p`)."""
    size, at = F.col("size"), F.struct("draw", "size", F.col("doc_id").isNull(), "doc_id")
    cut = F.struct(f"{p}cut_draw", f"{p}cut_size", F.col(f"{p}cut_id").isNull(), f"{p}cut_id")
    return F.col(f"{p}epochs") * size + F.when(F.col(f"{p}cut_draw").isNull(), F.lit(0)).when(at < cut, size).when(
        at.eqNullSafe(cut), F.col(f"{p}cut_taken")).otherwise(F.lit(0)).cast("long")


def mix_plan(rows: DataFrame, pattern: tuple[float, ...] = PATTERN, most_epochs: int = MOST_EPOCHS, slices: int = SLICES) -> DataFrame:
    """One row per source: source_size, weight, target, epochs and the cut (draw, size, id, words taken there)."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weights = F.array(*[F.lit(float(x)) for x in pattern])
    sources = totals.withColumn("weight", F.element_at(weights, (turn % len(pattern) + 1).cast("int")))
    plan = source_targets(sources, most_epochs)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-12), F.lit(most_epochs))).otherwise(0).cast("long"))
    plan = cut_lineage(plan.withColumn("rest", F.greatest(F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"), F.lit(0))))

    sized = rows.where("size > 0").withColumn("slice", F.floor((1 - F.exp(-F.col("draw"))) * slices))
    by_slice = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    small = broadcast_if_small(plan.select(F.col("source").alias("_s"), "rest"), 48)
    cut_slice = cut_lineage(by_slice.withColumn("upto", upto).join(small, F.col("source").eqNullSafe(F.col("_s")))
                            .where((F.col("rest") > 0) & (F.col("upto") - F.col("words") < F.col("rest")) & (F.col("rest") <= F.col("upto")))
                            .select(F.col("source").alias("_s"), F.col("slice").alias("_slice"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left")))
    there = (sized.join(broadcast_if_small(cut_slice, 48), F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_slice")))
             .groupBy("source", "draw", "size", "doc_id", "left").agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("source").orderBy("draw", "size", F.col("doc_id").isNull(), "doc_id"))
    prior = F.col("upto") - F.col("size") * F.col("n")
    cut = (there.withColumn("upto", upto).where((prior < F.col("left")) & (F.col("left") <= F.col("upto")))
           .select(F.col("source").alias("_s"), F.col("draw").alias("cut_draw"), F.col("size").alias("cut_size"), F.col("doc_id").alias("cut_id"),
                   F.floor((F.col("left") - prior) / F.col("n")).alias("cut_taken")))
    return cut_lineage(plan.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "rest"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents repeated as often as the mix takes them; columns stay as they are.

    Whole texts only: the document at a source's cut stays if half of it or more is taken.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
                         word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), letter_share(F.col("text"))).alias("draw"))
    slim = cut_lineage(packed.select("doc_id", "source", "size", "draw"))
    plan = mix_plan(slim, **options)
    p = plan.select(*[F.col(c).alias(f"p_{c}") for c in plan.columns])
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.round(taken_words("p_") / F.greatest(F.col("size"), F.lit(1)))).cast("int")
    return (packed.join(broadcast_if_small(p, 128), F.col("source").eqNullSafe(F.col("p_source"))).withColumn("_n", copies).where("_n > 0")
            .select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).select("_row.*"))
