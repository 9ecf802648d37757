"""Document fingerprints by consistent weighted sampling over word frequencies.

The first, second, ... occurrence of a term is dealt into one of 128 bins by a
hash of the term and its number, so a term's weight spreads over the bins and
each bin is a fair sample of all occurrences. A term of weight w in a bin draws r, c ~
Gamma(2,1) and b ~ U(0,1) from a hash of term and bin, t = floor(ln w / r + b)
and ln a = ln c - r (t - b + 1); the term with the smallest a gives the bin's
sample (term, t). Two documents agree in a bin with probability equal to the
generalised Jaccard similarity of their weights there. Its mean over the dealing is the
similarity of the documents, as every occurrence of their union is as likely to
be in the bin, so the share of agreeing bins, among bins that either fills, is
unbiased whatever the weights. At most one evaluation per occurrence instead of one
per term and sample keeps the work linear in the text. A document that fills all
128 bins gives 128 samples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.llm.common import plain

BINS = 128
ROWS_PER_RANGE, LEAST_RANGES, MOST_RANGES = 20_000, 256, 4096


def _uniform(term: Column, spot: Column, draw: int) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(term, spot, F.lit(draw)), 11).cast("double") + 0.5) * F.lit(2.0 ** -53)


def dealt(term: Column, count: Column) -> Column:
    """The bin of each occurrence of a term."""
    return F.transform(F.sequence(F.lit(1).cast("long"), count), lambda i: F.xxhash64(term, i, F.lit(6)).bitwiseAND(F.lit(BINS - 1)))


def sample(term: Column, spot: Column, weight: Column) -> Column:
    """`packed` of a term of `weight` in bin `spot`; the smallest of a bin holds a 31-bit rank and a 16-bit sample id."""
    r = -F.ln(_uniform(term, spot, 1) * _uniform(term, spot, 2))
    ln_c = F.ln(-F.ln(_uniform(term, spot, 3) * _uniform(term, spot, 4)))
    beta = _uniform(term, spot, 5)
    t = F.floor(F.ln(weight) / r + beta)
    ln_a = ln_c - r * (t - beta + 1)
    rank = F.greatest(F.least(((ln_a + 256) * float(1 << 22)).cast("long"), F.lit((1 << 31) - 1)), F.lit(0).cast("long"))
    ident = F.xxhash64(term, t).bitwiseAND(F.lit(0xFFFF))
    return F.shiftleft(rank, 16).bitwiseOR(ident)


def entries(parts: Column) -> Column:
    """Sorted bin << 16 | sample id of the collected (bin, packed) pairs."""
    return F.array_sort(F.transform(parts, lambda p: F.shiftleft(p.bin, 16).bitwiseOR(p.packed.bitwiseAND(F.lit(0xFFFF)))))


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among the bins that either side fills."""
    bins = lambda x: F.transform(x, lambda e: F.shiftright(e, 16))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(bins(a), bins(b)))


def as_text(e: Column) -> Column:
    """Six hexadecimal digits for each filled bin: two for the bin, four for its sample."""
    return F.array_join(F.transform(e, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def _bounds(docs: DataFrame) -> list[int]:
    """Lower bounds of all id ranges but the first: quantiles of the ids, at most 4,095 numbers."""
    found = docs.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("lo")).first()
    n = found.n or 0
    if not n:
        return []
    ranges = min(MOST_RANGES, max(LEAST_RANGES, math.ceil(n / ROWS_PER_RANGE)))
    marks = [i / ranges for i in range(1, ranges)]
    got = docs.agg(F.percentile_approx("doc_id", marks, 20 * ranges).alias("q")).first().q
    return sorted({q for q in got if q > found.lo})


def neighbours(docs: DataFrame) -> DataFrame:
    """(range, rn, doc_id, text, next_text, tail): the next row's text in (doc_id, digest) order, cyclic.

    `tail` rows repeat the first row of the next range and only serve as
    neighbours. That row is known from one short row per range before any text
    moves, so texts are shuffled once. Equal ids are ordered by digest, a null id comes first.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("dig", F.md5("text"))
    bounds = _bounds(docs)
    last = len(bounds)
    if bounds:
        cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
        own = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(cuts, lambda b: b <= F.col("doc_id"))))
    else:
        own = F.lit(0)
    placed = base.withColumn("own", own.cast("int"))
    # The first (doc_id, digest) of every range; one short row per range.
    heads = (placed.groupBy("own").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "dig")).alias("h"))
             .select(F.col("own").alias("h_own"), F.col("h.doc_id").alias("h_id"), F.col("h.dig").alias("h_dig")))
    is_head = (F.col("own") == F.col("h_own")) & F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("dig") == F.col("h_dig"))
    marked = placed.join(F.broadcast(heads), is_head, "left")
    before = F.when(F.col("own") == 0, F.lit(last)).otherwise(F.col("own") - 1)
    spots = F.when(F.col("h_own").isNotNull(), F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("tail")),
                                                      F.struct(before.alias("range"), F.lit(True).alias("tail")))
                   ).otherwise(F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("tail"))))
    spread = marked.select("doc_id", "text", "dig", F.inline(spots))
    order = Window.partitionBy("range").orderBy("tail", F.col("doc_id").isNotNull(), "doc_id", "dig")
    return spread.select("range", F.row_number().over(order).alias("rn"), "doc_id", "text", F.lead("text").over(order).alias("next_text"), "tail")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document's. Null counts as empty; texts without a
    letter or digit have the fingerprint of the empty word, so they are alike.
    The next row of a repeated id is the one with the next digest; with a single
    document it is that document. Text moves once, and every later grouping is by the same range.
    """
    rows = neighbours(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    nxt = F.coalesce("next_text", F.lit(""))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(nxt, F.lit(1), half))
    rows = rows.select("range", "rn", "doc_id", "text", "tail", n.cast("long").alias("n_chars"), F.when(~F.col("tail"), edited).alias("edited"))
    meta = F.struct("doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), "tail")
    no_meta = F.lit(None).cast("struct<doc_id:bigint,n_chars:bigint,sha:string,tail:boolean>")
    words = lambda c: F.transform(F.split(plain(F.col(c)), " "), lambda w: F.xxhash64(w))
    sides = F.array(F.struct(F.lit(0).alias("side"), words("text").alias("terms"), no_meta.alias("meta")),
                    F.struct(F.lit(1).alias("side"), F.when(~F.col("tail"), words("edited")).alias("terms"), no_meta.alias("meta")),
                    F.struct(F.lit(2).alias("side"), F.array(F.lit(0).cast("long")).alias("terms"), meta.alias("meta")))
    terms = rows.select("range", "rn", F.inline(sides)).select("range", "rn", "side", "meta", F.explode("terms").alias("term"))
    counted = terms.groupBy("range", "rn", "side", "meta", "term").agg(F.count(F.lit(1)).alias("w"))
    spread = counted.select("range", "rn", "side", "meta", "term", F.explode(dealt(F.col("term"), F.col("w"))).alias("bin"))
    weighed = spread.groupBy("range", "rn", "side", "meta", "term", "bin").agg(F.count(F.lit(1)).alias("w"))
    packed = sample(F.col("term"), F.col("bin"), F.col("w"))
    least = weighed.select("range", "rn", "side", "meta", "bin", packed.alias("packed")).groupBy("range", "rn", "side", "meta", "bin").agg(F.min("packed").alias("packed"))
    pair = F.struct(F.col("bin"), F.col("packed"))
    both = least.groupBy("range", "rn").agg(
        F.first("meta", ignorenulls=True).alias("meta"),
        F.collect_list(F.when(F.col("side") == 0, pair)).alias("own"), F.collect_list(F.when(F.col("side") == 1, pair)).alias("new"))
    prints = both.select("range", "rn", "meta", entries(F.col("own")).alias("own"), entries(F.col("new")).alias("new"))
    nearby = prints.withColumn("next", F.lead("own").over(Window.partitionBy("range").orderBy("rn")))
    return nearby.where(~F.col("meta.tail")).select(
        F.col("meta.doc_id").alias("doc_id"), F.col("meta.n_chars").alias("n_chars"), F.col("meta.sha").alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
