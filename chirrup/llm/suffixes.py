"""Removal of repeated byte strings by suffix arrays over shards.

Every string of `span` bytes is keyed by the least hash of the short grams inside it, so equal
strings have equal keys wherever they are. Neighbouring strings with one key are one stretch of
text. Keys found in one place only cannot repeat and go no further; the stretches of the others are
dealt to shards by key. A shard concatenates its stretches, sorts their suffixes by Larsson-Sadakane
refinement (groups of equal prefixes are refined by the rank of what follows, doubling the depth)
and finds common prefixes by Kasai's walk along the text, all stretches in step. Suffixes that
share `span` bytes with a neighbour repeat.

A key with more text than a shard holds is split over shards. Each of them emits its sorted distinct
strings by digest, and ranges of digests from all shards are merged by binary search.

Equal stretches are one stretch with a weight, and equal texts are keyed once by two hashes, so
copies cost no suffixes. Shards, blocks of long texts and merge ranges are bounded in bytes; nothing
but counts of short tables comes to the driver.

Defined results: a null text is empty; a text shorter than `span` keeps everything; repeated rows
are places of their own, so an equal row makes a text repeat; bytes are removed by what the input
holds, not by what is left; the remaining bytes need not be valid UTF-8 and are binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import _powers, broadcast_if_small, mix64, slices, stored

SPAN = 200  # bytes of a string that counts as repeated
GRAM = 64  # bytes hashed for the key; a power of two below SPAN
BLOCK = 1 << 20  # string starts of a long text that are keyed at once
STRETCH = 1 << 12  # string starts of one stretch, at most
SHARD_BYTES = 1 << 21  # text of one suffix array
MERGE_ROWS = 1 << 19  # digests merged in one task

_U = np.uint64
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) + _U(77))
_STEPS = mix64(np.arange(1, 65, dtype=np.uint64) + _U(990)) | _U(1)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes of the text (null is empty)."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def repeated_spans(docs: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(k1, k2, spans) of each distinct text with repeated bytes; spans are [start, stop) in bytes, maximal and ascending."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") >= span).select(*text_key(F.col("text")), "text")
    runs = stored(texts.mapInArrow(_keyed(span), "bucket bigint, cid bigint, k1 bigint, k2 bigint, at int, windows int, places int"), "suffix-keys")
    often = runs.groupBy("bucket").agg(F.sum("places").alias("n")).where("n > 1").select("bucket")
    # one row per stretch of a distinct text, with the number of its copies
    found = stored(runs.join(often, "bucket").groupBy("bucket", "cid", "k1", "k2", "at", "windows").agg(F.count(F.lit(1)).alias("copies")), "suffix-stretches")
    distinct = found.groupBy("bucket", "cid", "windows").agg(
        F.sum("copies").alias("weight"), F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("at").alias("at"))
    distinct = stored(distinct, "suffix-distinct")
    repeats = _repeats(_dealt(_cut(distinct, texts, span), distinct, span, shard_bytes), span, shard_bytes)
    hits = found.join(repeats, ["bucket", "cid"]).select("k1", "k2", (F.col("at") + F.col("off")).alias("start"), (F.col("at") + F.col("off") + F.col("count") + span - 1).alias("stop"))
    return hits.groupBy("k1", "k2").agg(_merged(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def remove_repeats(docs: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row as struct `row`, with its `spans` of repeated bytes, `n_bytes`, `n_removed` and the `kept` bytes (binary)."""
    spans = stored(repeated_spans(docs, span, shard_bytes), "suffix-spans")
    weight = spans.agg(F.sum(F.size("spans"))).head()[0] or 0
    small = broadcast_if_small(spans, 48 + 16 * (int(weight) // max(spans.count(), 1) + 1))
    text = F.coalesce("row.text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *text_key(F.col("text")))
    joined = rows.join(small, ["k1", "k2"], "left").select("row", F.coalesce("spans", F.array().cast("array<struct<start: int, stop: int>>")).alias("spans"))
    kept = F.when(F.size("spans") == 0, text.cast("binary")).otherwise(_without(text, F.col("spans")))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return joined.select("row", "spans", F.octet_length(text).cast("long").alias("n_bytes"), removed.alias("n_removed"), kept.alias("kept"))


def _merged(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones joined."""
    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (s["start"] <= last["stop"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        return F.when(joins, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start: int, stop: int>>"), add)


def _without(text: Column, spans: Column) -> Column:
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, lists):
            raw, at, parts = memoryview(t.as_buffer()), 0, []
            for span in s.as_py():
                parts.append(raw[at : span["start"]])
                at = span["stop"]
            out.append(b"".join([*parts, raw[at:]]))
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(text, spans)


# ---- keys of all strings of a text --------------------------------------------------------------

def _sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """The least or greatest of every `width` neighbours."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _grams(data: np.ndarray) -> np.ndarray:
    h, width = _BYTES[data], 1
    while width < GRAM:
        h = h[:-width] * _STEPS[width] + h[width:]
        width *= 2
    return mix64(h)


def _stretches(data: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """(piece, start in it, windows, bucket, cid, places) of every run of strings with one key, none across `ends`."""
    least = span - GRAM + 1
    if len(data) < span:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    h = _grams(data)
    m = _sliding(h, least, np.minimum)
    begins = np.concatenate(([0], ends[:-1]))
    long = ends - begins >= span
    edge = np.zeros(len(m) + 1, np.int64)
    edge[begins[long]] += 1
    edge[ends[long] - span + 1] -= 1
    valid = np.cumsum(edge[:-1]) > 0
    # a gram is a place of its key if it is the least of some string; a key with two places here repeats
    pad = np.zeros(least - 1, _U)
    peak = _sliding(np.concatenate((pad, np.where(valid, m, _U(0)), pad)), least, np.maximum)
    places = np.sort(h[(peak == h) & (peak > 0)])
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (m[1:] != m[:-1])
    start = np.flatnonzero(new)
    upto = np.concatenate(([0], np.cumsum(valid)))
    windows = np.diff(np.append(upto[start], upto[-1]))
    parts = -(-windows // STRETCH)
    at = np.repeat(start, parts)
    step = (np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
    windows = np.minimum(np.repeat(windows, parts) - step, STRETCH)
    at = at + step
    bucket = m[at]
    up, down = _powers(len(h) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix64(h + _U(1)) * up[: len(h)], dtype=_U)))
    cid = mix64((total[at + windows + least - 1] - total[at]) * down[at])
    count = np.searchsorted(places, bucket, "right") - np.searchsorted(places, bucket, "left")
    piece = np.searchsorted(ends, at, "right")
    return piece, at - begins[piece], windows, bucket.view(np.int64), cid.view(np.int64), count


def _pieces(column: pa.Array, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, text index, offset in the text) of whole texts together, or of the blocks of one long text."""
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offs[0] : offs[-1]]
    offs -= offs[0]
    if len(column) > 1 or len(data) <= BLOCK + span:
        yield data, offs[1:], np.arange(len(column)), np.zeros(len(column), np.int64)
        return
    for at in range(0, len(data) - span + 1, BLOCK):
        block = data[at : at + BLOCK + span - 1]
        yield block, np.array([len(block)]), np.zeros(1, np.int64), np.array([at])


def _keyed(span: int) -> Callable:
    names = ["bucket", "cid", "k1", "k2", "at", "windows", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
                for data, ends, doc, base in _pieces(part.column("text"), span):
                    piece, at, windows, bucket, cid, places = _stretches(data, ends, span)
                    columns = [bucket, cid, k1[doc[piece]], k2[doc[piece]], (at + base[piece]).astype(np.int32), windows.astype(np.int32), places.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


# ---- shards of suffixes -------------------------------------------------------------------------

def _cut(distinct: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """(bucket, cid, weight, body): the bytes of each distinct stretch, cut from one text that has it."""
    wanted = distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct("bucket", "cid", "weight", "at", "windows")).alias("places"))
    once = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    names = ["bucket", "cid", "weight", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                lists = part.column("places")
                flat = lists.flatten()
                counts = lists.value_lengths().to_numpy()
                at, windows = flat.field("at").to_numpy(), flat.field("windows").to_numpy()
                first = np.concatenate(([0], np.cumsum(counts)))
                bodies = []
                for i, text in enumerate(part.column("text")):
                    raw = memoryview(text.as_buffer())
                    bodies += [raw[a : a + w + span - 1] for a, w in zip(at[first[i] : first[i + 1]], windows[first[i] : first[i + 1]])]
                yield pa.RecordBatch.from_arrays([flat.field("bucket"), flat.field("cid"), flat.field("weight"), pa.array(bodies, pa.binary())], names)

    return once.join(wanted, ["k1", "k2"]).select("text", "places").mapInArrow(run, "bucket bigint, cid bigint, weight bigint, body binary")


def _dealt(cut: DataFrame, distinct: DataFrame, span: int, shard_bytes: int) -> DataFrame:
    """Stretches by shard: all of a key together, or split by content where a key has more than a shard holds."""
    sizes = distinct.groupBy("bucket").agg(F.sum(F.col("windows").cast("long") + span - 1).alias("bytes"))
    large = stored(sizes.where(F.col("bytes") > shard_bytes).select("bucket", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("shards")), "suffix-large")
    joined = cut.join(broadcast_if_small(large, 24), "bucket", "left")
    shards = F.coalesce("shards", F.lit(1))
    dealt = joined.select("bucket", F.pmod("cid", shards).cast("int").alias("shard"), (shards > 1).alias("split"), "cid", "weight", "body")
    return dealt.repartition("bucket", "shard").sortWithinPartitions("bucket", "shard", "cid")


_FOUND = "bucket bigint, cid bigint, off int, count int, d1 bigint, d2 bigint, open boolean"
_FOUND_ARROW = pa.schema([("bucket", pa.int64()), ("cid", pa.int64()), ("off", pa.int32()), ("count", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("open", pa.bool_())])


def _repeats(dealt: DataFrame, span: int, shard_bytes: int) -> DataFrame:
    """(bucket, cid, off, count): runs of repeated strings in each distinct stretch."""
    found = stored(dealt.mapInArrow(_arrays(span, shard_bytes), _FOUND), "suffix-found")
    inside = found.where("d1 IS NULL").select("bucket", "cid", "off", "count")
    strings = found.where("d1 IS NOT NULL")
    n = strings.count()
    if not n:
        return inside
    merged = strings.repartition(-(-n // MERGE_ROWS), "d1").mapInArrow(_merge, "bucket bigint, cid bigint, off int, count int")
    return inside.unionByName(merged)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of split keys that another shard has too.

    Each shard's strings are distinct, so a digest found twice comes from two
    shards; every string looks for its own range in the sorted digests.
    """
    held = [b for b in batches if len(b)]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    digest = np.zeros(len(rows), [("a", np.int64), ("b", np.int64)])
    digest["a"], digest["b"] = rows.column("d1").to_numpy(), rows.column("d2").to_numpy()
    order = np.lexsort((digest["b"], digest["a"]))
    _, name = np.unique(digest, return_inverse=True)
    ranked = name[order]
    twice = np.searchsorted(ranked, name, "right") - np.searchsorted(ranked, name, "left") > 1
    hit = rows.filter(pa.array(twice & rows.column("open").to_numpy()))
    yield from hit.select(["bucket", "cid", "off", "count"]).to_batches()


def _arrays(span: int, shard_bytes: int) -> Callable:
    """Suffix arrays of whole (bucket, shard) groups, several small groups in one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, []  # whole groups, their bytes, and the group being read
        group_size, last = 0, None
        for batch in batches:
            if not len(batch):
                continue
            bucket, shard = batch.column("bucket").to_numpy(), batch.column("shard").to_numpy()
            change = np.flatnonzero((bucket[1:] != bucket[:-1]) | (shard[1:] != shard[:-1])) + 1
            bounds = [0, *change.tolist(), len(batch)]
            sizes = np.concatenate(([0], np.cumsum([len(b.as_buffer()) for b in batch.column("body")])))
            for a, b in zip(bounds, bounds[1:]):
                key = (bucket[a], shard[a])
                if key != last:
                    if size + group_size > shard_bytes and held:
                        yield from _repeated(pa.Table.from_batches(held), span)
                        held, size = [], 0
                    held, size, group, group_size, last = held + group, size + group_size, [], 0, key
                group.append(batch.slice(a, b - a))
                group_size += int(sizes[b] - sizes[a])
        if size + group_size > shard_bytes and held:
            yield from _repeated(pa.Table.from_batches(held), span)
            held = []
        if held or group:
            yield from _repeated(pa.Table.from_batches(held + group), span)

    return run


def _repeated(rows: pa.Table, span: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings of one shard; of split keys also every distinct string, by digest."""
    rows = rows.combine_chunks()
    body = rows.column("body").chunk(0)
    offs = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
    data = np.frombuffer(body.buffers()[2], np.uint8)[offs[0] : offs[-1]]
    offs -= offs[0]
    weight = rows.column("weight").to_numpy()
    sa, rank = suffix_array(data, offs, span)
    lcp = common_prefixes(data, offs, sa, rank, span)
    of = np.repeat(np.arange(len(body)), np.diff(offs))
    string = offs[1:][of] - np.arange(len(data)) >= span  # a whole string starts here
    slots = np.flatnonzero(string[sa])
    at = sa[slots]
    head = np.flatnonzero(lcp[slots] < span)
    total = np.add.reduceat(weight[of[at]], head) if len(head) else np.zeros(0, np.int64)
    members = np.diff(np.append(head, len(at)))
    again = np.zeros(len(data) + 1, bool)
    again[at] = np.repeat(total > 1, members)
    edge = again[:-1] & ~np.concatenate(([False], again[:-1][:-1] & (of[1:] == of[:-1])))
    start = np.flatnonzero(edge)
    upto = np.concatenate(([0], np.cumsum(again[:-1])))
    count = np.diff(np.append(upto[start], upto[-1]))
    bucket, cid = rows.column("bucket").to_numpy(), rows.column("cid").to_numpy()
    none = np.full(len(start), True)
    yield _found(bucket[of[start]], cid[of[start]], start - offs[of[start]], count, pa.nulls(len(start), pa.int64()), pa.nulls(len(start), pa.int64()), ~none)
    split = rows.column("split").to_numpy()
    first = at[head]
    keep = split[of[first]]
    if keep.any():
        first, open_ = first[keep], (total <= 1)[keep]
        d1, d2 = _digests(data, first, span)
        yield _found(bucket[of[first]], cid[of[first]], first - offs[of[first]], np.ones(len(first), np.int32), pa.array(d1), pa.array(d2), open_)


def _found(bucket, cid, off, count, d1, d2, open_) -> pa.RecordBatch:
    columns = [pa.array(bucket), pa.array(cid), pa.array(off.astype(np.int32)), pa.array(count.astype(np.int32)), d1, d2, pa.array(open_)]
    return pa.RecordBatch.from_arrays(columns, schema=_FOUND_ARROW)


def _digests(data: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the strings that start at `at`."""
    h = _grams(data)
    up, down = _powers(len(h) + 1)
    out = []
    for seed in (3, 4):
        total = np.concatenate((np.zeros(1, _U), np.cumsum(mix64(h + _U(seed)) * up[: len(h)], dtype=_U)))
        out.append(mix64((total[at + span - GRAM + 1] - total[at]) * down[at]).view(np.int64))
    return out[0], out[1]


# ---- suffix array and common prefixes -----------------------------------------------------------

_PACKED = 7  # symbols of nine bits in the first sort key


def suffix_array(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first `depth` bytes, group of each suffix) of the texts between `offs`.

    Every text is followed by a symbol below every byte. Larsson-Sadakane:
    suffixes with equal first h symbols form a group named by its first slot;
    each round sorts the members of open groups by the group of the suffix h
    symbols on. Groups of one, or whose members have ended, are closed and never
    touched again.
    """
    texts, n = len(offs) - 1, len(data)
    size = n + texts
    place = np.arange(n, dtype=np.int32) + np.repeat(np.arange(texts, dtype=np.int32), np.diff(offs))
    symbol = np.zeros(size + _PACKED, np.int64)
    symbol[place] = data
    symbol[place] += 1
    left = np.zeros(size, np.int32)
    left[place] = np.repeat(offs[1:].astype(np.int32), np.diff(offs)) - np.arange(n, dtype=np.int32)
    pairs = symbol[:-1] << 9 | symbol[1:]
    fours = pairs[:-2] << 18 | pairs[2:]
    key = ((fours[:size] << 18 | pairs[4 : size + 4]) << 9) | symbol[6 : size + 6]
    short = np.flatnonzero(left < _PACKED)  # nothing after the end counts
    beyond = 9 * (_PACKED - left[short].astype(np.int64))
    key[short] = key[short] >> beyond << beyond
    sa = np.argsort(key)
    key, sa = key[sa], sa.astype(np.int32)
    slots = np.arange(size, dtype=np.int32)
    rank = np.empty(size, np.int32)
    slots, at = _named(key, slots, sa, rank)
    slots, h = slots[left[at] >= _PACKED], _PACKED
    while len(slots) and h < depth:
        at = sa[slots]
        key = rank[at].astype(np.int64)
        key *= size + 1
        key += rank[at + h]  # members of an open group have h symbols, so this is their end at most
        order = np.argsort(key)
        at = at[order]
        sa[slots] = at
        slots, at = _named(key[order], slots, at, rank)
        h *= 2
        slots = slots[left[at] >= h]
    back = np.zeros(size, np.int32)
    back[place] = np.arange(n, dtype=np.int32)
    return back[sa[texts:]], rank[place]  # the end symbols sort first


def _named(ordered: np.ndarray, slots: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Write the first slot of its group as `rank` of every suffix; the slots and suffixes of groups of two or more."""
    new = np.ones(len(ordered) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:-1])
    rank[at] = np.maximum.accumulate(np.where(new[:-1], slots, 0))
    shared = ~(new[:-1] & new[1:])
    return slots[shared], at[shared]


def common_prefixes(data: np.ndarray, offs: np.ndarray, sa: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to `most`, that each suffix with as many bytes shares with the one before it in order.

    Kasai: along a text the common prefix shrinks by one at most from start to
    start, so comparison goes on where it stood. All texts walk in step, eight
    bytes a comparison. Members of one group share `most` bytes, as they are
    sorted by at least as many. Shorter suffixes are left at 0.
    """
    n = len(data)
    lcp = np.zeros(n, np.int64)
    slot = np.empty(n, np.int32)
    slot[sa] = np.arange(n, dtype=np.int32)
    end = np.repeat(offs[1:], np.diff(offs))
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    word = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    starts = np.diff(offs) - most + 1
    order = np.argsort(-starts, kind="stable")
    starts, begin = starts[order], offs[:-1][order]
    shared = np.zeros(len(begin), np.int64)
    for step in range(int(starts.max(initial=0))):
        lanes = int(np.searchsorted(-starts, -step, "left"))  # texts with a start at this step
        at = begin[:lanes] + step
        here = slot[at]
        before = sa[np.maximum(here - 1, 0)]
        limit = np.where(here > 0, np.minimum(most, end[before] - before), 0)
        equal = (rank[before] == rank[at]) & (here > 0)
        h = np.where(equal, limit, np.minimum(shared[:lanes], limit))
        open_ = np.flatnonzero(h < limit)
        while len(open_):
            x = word[at[open_] + h[open_]] ^ word[before[open_] + h[open_]]
            low = x & (~x + _U(1))
            same = np.where(x == 0, 8, np.log2(np.maximum(low, _U(1)).astype(np.float64)).astype(np.int64) >> 3)
            grown = np.minimum(h[open_] + same, limit[open_])
            h[open_] = grown
            open_ = open_[(same == 8) & (grown < limit[open_])]
        lcp[here] = h
        shared[:lanes] = np.where(equal, 0, np.maximum(h - 1, 0))  # the order inside a group says nothing about the next start
    return lcp
