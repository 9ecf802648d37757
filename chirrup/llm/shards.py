"""Sharding by extendible hashing: a directory of hash prefixes whose oversized buckets split on another bit.

Every row has a 60-bit hash of its id and text. The directory starts from byte
sums per prefix of a depth that follows from the total; a bucket is the
shortest prefix whose bytes fit the limit. Prefixes that do not fit at that
depth are resolved on further bits. Rows that share all 60 bits (repeated rows)
cannot be told apart by a prefix; such a bucket is dealt out by counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import broadcast_if_small
from chirrup.session import cut_lineage

BITS = 60
STEP = 12
SHARD_BYTES = 1 << 20


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text; null and empty are told apart."""
    tagged = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.concat(F.lit("t"), F.md5(text)), F.lit("n")))
    return F.conv(F.substring(F.md5(tagged), 1, 15), 16, 10).cast("long")


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _leaves(rows: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """(leaf, depth, bytes, rows, fits) per `depth`-bit prefix: the shortest prefix above `base` bits that fits."""
    sums = rows.groupBy(F.shiftright("h", BITS - depth).alias("leaf")).agg(F.sum("bytes").alias("b"), F.sum("n").alias("n"))
    levels = sums.select("leaf", "b", "n", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("d"))
    at = F.expr(f"shiftright(leaf, {depth} - d)")
    nodes = levels.groupBy("d", at.alias("p")).agg(F.sum("b").alias("bytes"), F.sum("n").alias("rows"))
    fit = (levels.select("leaf", "d", at.alias("p")).join(nodes.where((F.col("bytes") <= limit) | (F.col("d") == depth)), ["d", "p"])
           .groupBy("leaf").agg(F.min(F.struct("d", "bytes", "rows")).alias("x")))
    return fit.select("leaf", F.col("x.d").alias("depth"), F.col("x.bytes").alias("bytes"), F.col("x.rows").alias("rows"),
                      (F.col("x.bytes") <= limit).alias("fits"))


def directory(hashed: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(bits, leaf, depth, bytes, rows, fits) over hashed(h, bytes): rows with prefix `leaf` of `bits` bits are in the bucket `leaf >> (bits - depth)`.

    Each pass looks at the rows of the prefixes that the pass before left too
    large; a pass adds at most 12 bits, so there are at most five.
    """
    rows = hashed.groupBy("h").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows)
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(4, (total // max(1, limit)).bit_length() + 4))
    base, parts = 0, None
    while True:
        leaves = cut_lineage(_leaves(rows, base, depth, limit).withColumn("bits", F.lit(depth)))
        whole = leaves.where("fits") if depth < BITS else leaves
        parts = whole if parts is None else parts.union(whole)
        large = leaves.where("not fits").select(F.col("leaf").alias("_leaf"))
        if depth == BITS or not large.limit(1).count():
            return parts.select("bits", "leaf", "depth", "bytes", "rows", "fits")
        rows = cut_lineage(rows.join(broadcast_if_small(large, 16), F.shiftright("h", BITS - depth) == F.col("_leaf"), "left_semi"))
        base, depth = depth, min(BITS, depth + STEP)


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The documents with `shard` (text), `shard_bytes` and `shard_rows` added.

    A shard is named by its bucket's hash prefix in bits (`-` for no bit). A
    single row larger than the limit is alone in its shard. Repeated rows that
    no prefix separates are dealt evenly over `prefix/0`, `prefix/1`, ... of at
    most limit bytes. Null and empty texts count 0 bytes. A column of
    the input that bears one of the three names is replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("shard", "shard_bytes", "shard_rows")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                         row_hash(F.col("doc_id"), F.col("text")).alias("h"), row_bytes(F.col("text")).alias("bytes"))
    tree = cut_lineage(directory(packed.select("h", "bytes"), limit))
    tree = tree.withColumnsRenamed({"bytes": "b", "rows": "r"})
    depths = [r.bits for r in tree.select("bits").distinct().collect()]  # five values at most
    if not depths:
        return docs.select(*names).withColumns({"shard": F.lit(""), "shard_bytes": F.lit(0).cast("long"), "shard_rows": F.lit(0).cast("long")}).limit(0)
    if len(depths) == 1:
        keyed = packed.withColumn("_bits", F.lit(depths[0])).withColumn("_leaf", F.shiftright("h", BITS - depths[0]))
        found = keyed.join(broadcast_if_small(tree, 48), (F.col("leaf") == F.col("_leaf")))
    else:
        # A row matches the tree at exactly one of the few prefix lengths.
        tries = F.array(*[F.struct(F.lit(b).alias("bits"), F.shiftright("h", BITS - b).alias("leaf")) for b in sorted(depths)])
        slim = packed.select("h").distinct().select("h", F.inline(tries)).join(tree, ["bits", "leaf"]).select(
            F.col("h").alias("_h"), "bits", "leaf", "depth", "b", "r", "fits")
        slim = cut_lineage(slim)
        found = packed.join(broadcast_if_small(slim, 56), F.col("h") == F.col("_h"))
    prefix = F.when(F.col("depth") == 0, F.lit("-")).otherwise(
        F.expr("lpad(bin(shiftright(leaf, bits - depth)), depth, '0')"))
    found = found.withColumn("_p", prefix)
    per = F.greatest(F.floor(F.lit(limit) / F.greatest(F.col("bytes"), F.lit(1))), F.lit(1))
    fit = found.where("fits or r = 1").select("_row", F.col("_p").alias("shard"), F.col("b").alias("shard_bytes"), F.col("r").alias("shard_rows"))
    if not tree.where("not fits and r > 1").limit(1).count():
        return fit.select("_row.*", "shard", "shard_bytes", "shard_rows")
    # Rows of one 60-bit hash: counted as groups of equal rows, then numbered by arithmetic.
    same = found.where("not fits and r > 1").groupBy("_p", "r", "bytes", "_row").agg(F.count(F.lit(1)).alias("n"))
    same = same.withColumn("per", per).select("_row", "_p", "bytes", "per", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    whole = F.floor(F.col("i") / F.col("per"))
    held = F.least(F.col("per"), F.col("n") - whole * F.col("per"))
    dealt = same.select("_row", F.concat("_p", F.lit("/"), whole.cast("string")).alias("shard"), (held * F.col("bytes")).alias("shard_bytes"), held.alias("shard_rows"))
    return fit.unionByName(dealt).select("_row.*", "shard", "shard_bytes", "shard_rows")
