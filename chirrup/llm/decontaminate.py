"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment.

Items are put into size classes by powers of two of their shingle count. The
min-wise sketch of an item is its m smallest shingle hashes, where m follows
from the class's upper bound u: a document that contains a share t of at most u
shingles misses u - ceil(t*u) of them at most, so m = u - ceil(t*u) + 1 smallest
hashes always leave one that the document holds. No contained item is lost,
however long the document is. Candidates are verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup.llm.common import SIMILAR, WIDTH, broadcast_if_small, only, plain, without
from chirrup.session import cut_lineage


def _shingle_rows(df: DataFrame, keys: list[str], words: str, width: int) -> DataFrame:
    """One row per run of `width` words, hashed from the hashes of its words."""
    hashed = df.where(F.size(words) >= width).select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    n = F.size("_h") - (width - 1)
    runs = F.arrays_zip(*[F.slice("_h", i + 1, n).alias(f"w{i}") for i in range(width)])
    return hashed.select(*keys, F.inline(runs)).select(*keys, F.xxhash64(*[F.col(f"w{i}") for i in range(width)]).alias("h"))


def _grams(words: Column, width: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - width),
                                        lambda i: F.array_join(F.slice(words, i + 1, width), " ")))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, key, width, grams, n) of every item with a word; `key` tells apart rows of one id.

    An item of fewer than five words is one shingle of all its words.
    """
    w = items.select("item_id", plain(F.col("text")).alias("p")).where("p != ''").distinct().withColumn("w", F.split("p", " "))
    w = w.select("item_id", F.md5("p").alias("key"), "w", F.least(F.size("w"), F.lit(WIDTH)).alias("width"))
    return w.select("item_id", "key", "w", "width", _grams(F.col("w"), F.col("width")).alias("grams")).withColumn("n", F.size("grams"))


def contained_items(docs: DataFrame, items: DataFrame, share: float = SIMILAR) -> DataFrame:
    """(doc_id, digest, item_id, shared, item_shingles, containment) with containment >= share.

    One row per distinct (doc_id, normalised text) and item; repeated rows count
    once. Null and empty texts and items hold nothing. Null ids are kept as ids.
    """
    spec = cut_lineage(item_shingles(items))
    widths = sorted(r.width for r in spec.select("width").distinct().collect())  # five values at most
    upper = F.expr("shiftleft(1, cast(floor(log2(n)) as int) + 1) - 1")
    order = Window.partitionBy("item_id", "key").orderBy("h")
    sketch = None
    for width in widths:
        rows = (_shingle_rows(spec.where(F.col("width") == width).withColumn("u", upper), ["item_id", "key", "u"], "w", width).distinct()
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("u") - F.ceil(F.col("u") * F.lit(share) - 1e-9) + 1)
                .select("h", "item_id", "key", F.lit(width).alias("width")))
        sketch = rows if sketch is None else sketch.union(rows)
    if sketch is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, digest string, item_id long, shared int, item_shingles int, containment double")
    sketch = cut_lineage(sketch)
    text = docs.select("doc_id", plain(F.col("text")).alias("p")).where("p != ''").select("doc_id", F.md5("p").alias("digest"), F.split("p", " ").alias("w"))
    found = None
    for width in widths:
        hits = (_shingle_rows(text, ["doc_id", "digest"], "w", width)
                .join(broadcast_if_small(sketch.where(F.col("width") == width).drop("width"), 64), "h")
                .select("doc_id", "digest", "item_id", "key"))
        found = hits if found is None else found.union(hits)
    found = cut_lineage(found.distinct())

    ids = broadcast_if_small(found.select("doc_id").distinct(), 16)
    texts = (only(docs.select("doc_id", "text"), ids, {"doc_id": F.col("doc_id")})
             .select("doc_id", plain(F.col("text")).alias("p")).withColumn("digest", F.md5("p")).dropDuplicates(["doc_id", "digest"]))
    cond = F.col("f.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("f.digest") == F.col("t.digest"))
    padded = F.concat(F.lit(" "), F.col("t.p"), F.lit(" "))
    pairs = found.alias("f").join(texts.alias("t"), cond).select("f.doc_id", "f.digest", "f.item_id", "f.key", padded.alias("_p"))
    grams = spec.select(F.col("item_id").alias("_i"), F.col("key").alias("_key"), "grams", "n")
    held = F.filter("grams", lambda g: F.contains(F.col("_p"), F.concat(F.lit(" "), g, F.lit(" "))))
    return (pairs.join(grams, F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_key")))
            .select("doc_id", "digest", "item_id", F.size(held).alias("shared"), F.col("n").alias("item_shingles"))
            .withColumn("containment", F.col("shared") / F.col("item_shingles"))
            .where(F.col("containment") >= share - 1e-12))


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = SIMILAR) -> DataFrame:
    """The documents that hold no item; columns stay as they are."""
    bad = cut_lineage(contained_items(docs, items, share).select("doc_id", "digest").distinct())
    keys = {"doc_id": F.col("doc_id"), "digest": F.md5(plain(F.col("text")))}
    return without(docs, broadcast_if_small(bad, 64), keys)
