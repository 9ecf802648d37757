"""Near-duplicate documents by weighted MinHash over bags of five-word shingles.

Signatures come from Poisson processes laid over discretised weights: a shingle
that occurs w times covers the weight axis up to w, which is cut into dyadic
blocks [0,1), [1,2), [2,4), ... Each block of each shingle has a process of its
own, seeded by (shingle, block), whose points fall at a rate of the block's
width per signature position and carry a position and a place on the weight
axis; points beyond w are thinned out. The earliest point of each position is
the signature value, so two bags agree at a position with probability equal to
their weighted Jaccard similarity. A process is dropped as soon as it has passed
the latest value of its document, which leaves about one point per shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import broadcast_if_small, components, mix64, only, plain, SIMILAR, slices, stored, TEXT_ROWS, without, Words

BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band with probability 3e-6
TURNS = 3  # second bands that split each bucket which holds several classes
SLICE, SLICE_BYTES = 512, 2 << 20  # texts of one slice of a bucket
AT_ONCE = 1 << 18  # text bytes of which a worker holds the arrays

_U = np.uint64
_UNIT = 2.0 ** -53


def _bags(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) with counts, in document order."""
    key = np.sort((doc.astype(_U) << _U(48)) | (h >> _U(16)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((first, [len(key)])))
    key = key[first]
    return (key >> _U(48)).astype(np.int64), key & _U((1 << 48) - 1), count


def signatures(doc: np.ndarray, h: np.ndarray, docs: int, size: int) -> np.ndarray:
    """A (docs, size) array of signature values; rows of documents without shingles are 0."""
    doc, h, weight = _bags(doc, h)
    owner, seed, low, width, upto = [], [], [], [], []
    block, lower, wide = 0, 0, 1
    rest = np.arange(len(h))
    while len(rest):
        owner.append(doc[rest])
        seed.append(mix64(h[rest] * _U(2) + _U(1)) ^ mix64(np.full(1, block + 1, _U))[0])
        low.append(np.full(len(rest), float(lower)))
        width.append(np.full(len(rest), float(wide)))
        upto.append(weight[rest].astype(float))
        block, lower = block + 1, lower + wide
        wide = max(1, lower)
        rest = rest[weight[rest] > lower]
    value = np.full(docs * size, np.inf)
    ident = np.zeros(docs * size, _U)
    if not owner:
        return ident.reshape(docs, size)
    owner, seed, low, width, upto = map(np.concatenate, (owner, seed, low, width, upto))
    time, step = np.zeros(len(owner)), 0
    present = np.zeros(docs, bool)
    present[owner] = True
    while len(owner):
        step += 1
        a = mix64(seed + _U(2 * step))
        b = mix64(seed + _U(2 * step + 1))
        time = time - np.log(((a >> _U(11)).astype(float) + 0.5) * _UNIT) / (width * size)
        place = low + width * ((b >> _U(32)).astype(float) * 2.0 ** -32)
        at = owner * size + ((b & _U(0xFFFFFFFF)) % _U(size)).astype(np.int64)
        hit = np.flatnonzero((place < upto) & (time < value[at]))
        np.minimum.at(value, at[hit], time[hit])
        best = hit[time[hit] == value[at[hit]]]
        ident[at[best]] = a[best]
        latest = np.where(present, value.reshape(docs, size).max(axis=1), -1.0)
        live = time < latest[owner]
        owner, seed, low, width, upto, time = (x[live] for x in (owner, seed, low, width, upto, time))
    return ident.reshape(docs, size)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "plain", AT_ONCE):
            words = Words(batch.column("plain"))
            sig = signatures(*words.shingles(), words.docs, BANDS * ROWS).reshape(-1, BANDS, ROWS)
            keys = np.zeros(sig.shape[:2], _U)
            for r in range(ROWS):
                keys = mix64(keys * _U(31) + sig[:, :, r])
            keys = mix64(keys + np.arange(1, BANDS + 1, dtype=_U)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), lists], ["doc_id", "node", "keys"])


def bag_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """Weighted Jaccard similarity of the shingle bags of two normalised texts."""
    out: list[np.ndarray] = []
    texts = pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["x", "y"])
    for part in slices(texts, "x", AT_ONCE):
        (left, h), (right, g) = (Words(part.column(c)).shingles() for c in ("x", "y"))
        doc, key = np.concatenate((left, right)), np.concatenate((h, g))
        order = np.lexsort((key, doc))
        doc, key, mine = doc[order], key[order], order < len(left)
        first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))))
        if not len(first):
            out.append(np.zeros(len(part)))
            continue
        x, y = (np.add.reduceat(m.astype(np.int64), first) for m in (mine, ~mine))
        shared, most = (np.bincount(doc[first], f(x, y), len(part)) for f in (np.minimum, np.maximum))
        out.append(shared / np.maximum(most, 1))
    return pd.Series(np.concatenate(out) if out else np.zeros(0))


def _kept(df: DataFrame) -> DataFrame:
    """A written intermediate table. Small tables come back as few partitions, so later stages have few tasks."""
    return stored(df, "near-dup", TEXT_ROWS)


def node_key(text: Column) -> Column:
    """The 128-bit digest of the normalised text: equal texts are one node."""
    return F.unhex(F.md5(plain(text)))


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, plain) of the wanted nodes; only their documents are normalised again."""
    asked = _kept(nodes.join(wanted, "node", "left_semi"))
    ids = broadcast_if_small(asked.select("doc_id").distinct(), 16)
    found = (only(docs.select("doc_id", "text"), ids, {"doc_id": F.col("doc_id")})
             .select(node_key(F.col("text")).alias("node"), plain(F.col("text")).alias("plain"))
             .join(broadcast_if_small(asked.select("node"), 40), "node", "left_semi").dropDuplicates(["node"]))
    return _kept(found)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity."""
    return (pairs.join(texts.select(F.col("node").alias("a"), F.col("plain").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("plain").alias("y")), "b")
            .where(F.pandas_udf(bag_overlap, "double")("x", "y") >= SIMILAR).select("a", "b"))


def _sub_bucket_pairs(members: DataFrame) -> DataFrame:
    """Pairs of nodes of different classes inside buckets of two bands, each node with one leader per bucket.

    Band i is joined with bands i + 1, ..., i + TURNS; the leader is the smallest by
    a hash that changes with the turn. Rows and pairs are linear in the members.
    """
    spots = F.sequence(F.lit(0), F.lit(BANDS - 1))
    keys = F.flatten(F.array(*[
        F.transform(spots, lambda i, t=t: F.struct(F.lit(t).alias("turn"), F.xxhash64(F.get("keys", i), F.get("keys", (i + t) % BANDS)).alias("key")))
        for t in range(1, TURNS + 1)]))
    rows = members.select("node", "label", F.inline(keys))
    order = F.struct(F.xxhash64("node", "turn").alias("h"), "node", "label")
    lead = (rows.groupBy("turn", "key").agg(F.min(order).alias("lead"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .where("lo != hi").select("turn", "key", F.col("lead.node").alias("lead"), F.col("lead.label").alias("lead_label")))
    return (rows.join(lead, ["turn", "key"]).where("label != lead_label")
            .select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct())


def _links_of_slices(table: pa.Table) -> pa.Table:
    """The pairs (a, b) of nodes of different classes that reach the similarity, in one slice of a bucket or between two.

    A bag is a set of tokens (shingle, how often it came before), so one lookup of all
    tokens of the group gives the exact overlap of a text with every other.
    """
    batch = table.combine_chunks().to_batches()[0]
    docs, keys, at = [], [], 0
    for part in slices(batch, "plain"):
        doc, h = Words(part.column("plain")).shingles()
        docs.append(doc + at)
        keys.append(h)
        at += len(part)
    doc, h = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
    place = np.arange(len(h))
    seen = (place - np.maximum.accumulate(np.where(fresh, place, 0))).astype(_U)
    distinct, token = np.unique(h ^ mix64(seen), return_inverse=True)
    size = np.bincount(doc, minlength=at)
    start = np.cumsum(size) - size
    label = batch.column("label").dictionary_encode().indices.to_numpy()
    slot, row = batch.column("slot").to_numpy(), np.arange(at)
    one = slot.min() == slot.max()
    left, right, present = [], [], np.zeros(len(distinct), np.int64)
    for i in row if one else np.flatnonzero(slot == slot.min()):
        other = (label != label[i]) & ((row > i) if one else (slot != slot[i]))
        other &= np.minimum(size, size[i]) >= np.maximum(size, size[i]) * (SIMILAR - 1e-9)
        if other.any():
            mine = token[start[i] : start[i] + size[i]]
            present[mine] = 1
            shared = np.add.reduceat(present[token], start)
            present[mine] = 0
            found = np.flatnonzero(other & (shared / (size + size[i] - shared) >= SIMILAR))
            left.append(np.full(len(found), i))
            right.append(found)
    x, y = (pa.array(np.concatenate(ends) if ends else np.zeros(0, np.int64)) for ends in (left, right))
    return pa.Table.from_arrays([batch.column("node").take(x), batch.column("node").take(y)], ["a", "b"])


def _open_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """All similar pairs of nodes that share a bucket and are in different classes.

    A bucket's nodes are dealt to slices of bounded size, and every two slices meet in a group
    of their own: a group's memory is bounded, a large bucket is many groups, and no pair is listed but the similar ones.
    """
    told = members.join(texts, "node")
    slots = F.greatest(F.ceil(F.col("n") / SLICE), F.ceil(F.col("bytes") / SLICE_BYTES)).cast("int")
    sizes = told.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("plain")).alias("bytes")).select("key", slots.alias("slots"))
    dealt = told.join(sizes, "key").select("key", "node", "label", "plain", F.pmod(F.xxhash64("node"), "slots").cast("int").alias("slot"), "slots")
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    return (met.groupBy("key", F.least("slot", "other").alias("lo"), F.greatest("slot", "other").alias("hi"))
            .applyInArrow(_links_of_slices, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _mixed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label) of the buckets of three or more nodes that hold several classes."""
    tagged = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = (tagged.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
             .where("lo != hi and n > 2").select("key"))
    return tagged.join(mixed, "key", "left_semi")


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, normalised text): doc_id, node, class_id, copies, kept.

    `class_id` is the smallest doc_id of the class, `copies` the repeated rows
    behind a row (same id, same normalised text), `kept` whether it is the one row of the
    class that stays. Null and empty texts, and texts without any letter or
    digit, have no shingle: each row is alone in its class (`node` null) and
    kept. A null doc_id sorts after all others.

    Equal normalised texts are one node, so copies never meet each other. In each band
    bucket every node is compared with the bucket's smallest node. Buckets of
    three or more that still hold different classes are then split by second
    bands into sub-buckets with leaders of their own. These two steps are linear and join most of
    what belongs together; in the buckets that hold different classes after them, all pairs of
    nodes of different classes are compared. So two texts that share a bucket are in one class
    or have been compared: a similar pair is lost only if it shares none of the bands.
    """
    base = docs.select("doc_id", "text", plain(F.col("text")).alias("plain"))
    worded = base.where(F.col("plain") != "").select("doc_id", "plain", F.unhex(F.md5("plain")).alias("node"))
    keyed = _kept(worded.mapInArrow(_band_keys, "doc_id long, node binary, keys array<long>"))
    rows = keyed.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("copies"))
    nodes = _kept(keyed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys")))
    bands = nodes.select(F.explode("keys").alias("key"), "node")
    lead = bands.groupBy("key").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = _kept(bands.join(lead.select("key", "lead"), "key"))
    ids = nodes.select("node", "doc_id")
    first = shared.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    first = _kept(first)
    wanted = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    edges = _kept(_verified(first, _texts(wanted, ids, docs)))
    labels = components(edges)

    def linked(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return _kept(_verified(pairs, _texts(wanted, ids, docs)))

    members = _mixed(shared, labels).select("node", "label").distinct()
    members = _kept(members.join(nodes.select("node", "keys"), "node"))
    again = _kept(_sub_bucket_pairs(members))
    more = linked(again)
    if not more.isEmpty():
        edges = edges.union(more)
        labels = components(edges)
    members = _kept(_mixed(shared, labels))
    last = _kept(_open_links(members, _texts(members.select("node").distinct(), ids, docs)))
    if not last.isEmpty():
        labels = components(edges.union(last))

    node_class = ids.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    heads = node_class.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("head"))
    node_class = node_class.join(heads, "label").select(
        "node", F.col("doc_id").alias("first_id"), F.col("head.doc_id").alias("class_id"), (F.col("head.node") == F.col("node")).alias("is_head"))
    out = rows.join(node_class, "node").select(
        "doc_id", "node", "class_id", "copies",
        (F.col("is_head") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("kept"))
    alone = base.where(F.col("plain") == "").select(
        "doc_id", F.lit(None).cast("binary").alias("node"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but one row of each class; columns stay as they are.

    Copied rows of the same id and text are reduced to one as well.
    """
    classes = _kept(near_classes(docs).where("node is not null and (not kept or copies > 1)"))
    keys = {"doc_id": F.col("doc_id"), "node": node_key(F.col("text"))}
    gone = _kept(classes.select("doc_id", "node"))
    stay = without(docs, broadcast_if_small(gone, 48), keys)
    twice = _kept(classes.where("kept and copies > 1").select("doc_id", "node"))
    if not twice.limit(1).count():
        return stay
    names = docs.columns
    one = (only(docs, broadcast_if_small(twice, 48), keys)
           .select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), node_key(F.col("text")).alias("_node"))
           .dropDuplicates(["_id", "_node"]).select("_row.*"))
    return stay.unionByName(one)
