"""Prefix trie of conversations, built as a burst trie.

A conversation is a path of turn ids. All paths start in one container under the root. A container
with too many turn ids is burst: the turns that all its paths share become a chain of nodes, and
the paths go on to one container for each next turn id. Only oversized containers are touched again.
Containers that fit are sorted and swept once, with the open nodes of the current path as a stack;
the nodes above them are summed up from their children, deepest burst first.

Equal paths are one row with a count before the first container is looked at, so copies of one
conversation never make a container large. A round of bursting always splits what it touches.

Defined results: null role or text is empty; turns are ordered by turn, null first, and ties by
the turn's digest; rows with a null conv_id belong to no conversation and are left out; repeated
rows are repeated turns; an empty table has no nodes, not even a root. Other columns are ignored.
The turn ids of one conversation (not its texts) are one row: 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chirrup.llm.common import broadcast_if_small, stored

MOST_TURNS = 1 << 14  # turn ids under one head that are sorted and swept together
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_IDS_PER_CHUNK = 1 << 16
_NODES_PER_BATCH = 1 << 13

_PATH = "array<struct<id: binary, chars: int>>"


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) with the ordered (id, chars) of the turns of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", F.struct(F.col("turn"), turn_id.alias("id"), F.char_length(text).alias("chars")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("path"))


def with_shared_start(every: DataFrame, span: int, most: int, digest: Column) -> DataFrame:
    """Paths whose first h = `digest` % (most + 1) turns are replaced by those of the first conversation of their span.

    That conversation is conv_id - conv_id % span; what it lacks stays out, and
    a conversation may end up without turns.
    """
    starts = every.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_first"), F.slice("path", 1, most).alias("_start"))
    h = (digest % (most + 1)).cast("int")
    joined = every.join(starts, F.col("conv_id") - F.col("conv_id") % span == F.col("_first"), "left")
    empty = F.array().cast(_PATH)
    own = F.slice("path", h + 1, F.greatest(F.size("path"), F.lit(1)))
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("_start", F.lit(1), h), empty), own).alias("path"))


def node_key(ids: Column) -> Column:
    """Digest of a prefix, given its turn ids."""
    return F.unhex(F.md5(F.unhex(F.array_join(F.transform(ids, F.hex), ""))))


def prefix_trie(every: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """One row per node of the paths (conv_id, path), with its digest `node` and that of its `parent`.

    Columns: node, parent, conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves (childless nodes of its subtree), saved
    (sum over its subtree of (n_convs - 1) * chars), ends_sha256 (digest of the
    members that end here). No container above `most_turns` is swept unless it
    is a single path.
    """
    every = stored(every.select("conv_id", "path"), "trie-paths")
    keyed = every.select("conv_id", node_key(F.col("path.id")).alias("node"))
    distinct = every.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    rows = distinct.withColumn("node", node_key(F.col("path.id"))).join(ends_digest(keyed), "node")
    live = stored(rows.select(
        F.col("path.id").alias("ids"), F.col("path.chars").alias("chars"), "n", "conv_id", "ends",
        F.lit(0).alias("depth"), node_key(F.array().cast("array<binary>")).alias("head")), "trie-live")
    containers, bursts = [], []
    while (big := _oversized(live, most_turns)) is not None:
        step, marks = len(bursts), broadcast_if_small(big.select("head", "shared"), 48)
        containers.append(live.join(marks, "head", "left_anti").withColumn("round", F.lit(step)))
        moved, longer = live.join(marks, "head"), F.size("ids") > F.col("shared")
        ended = moved.where(~longer).select(node_key(F.col("ids")).alias("node"), F.col("n").alias("own_n"), F.col("conv_id").alias("own_id"), "ends")
        bursts.append((big, ended))  # at most one path ends at a burst node, as paths are distinct
        deeper = F.col("shared") + 1
        live = stored(moved.where(longer).select(
            "ids", "chars", "n", "conv_id", "ends", deeper.alias("depth"), node_key(F.slice("ids", F.lit(1), deeper)).alias("head")), "trie-live")
    held = reduce(DataFrame.unionByName, containers, live.withColumn("round", F.lit(len(bursts))))
    swept = stored(_sorted_for_sweep(held).mapInArrow(_sweep, _SWEPT), "trie-nodes")
    nodes = stored(swept.drop("round", "head").unionByName(_upper_nodes(swept, bursts)), "trie-all")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent", "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))


# ---- containers ---------------------------------------------------------------------------------

def _oversized(live: DataFrame, most_turns: int) -> DataFrame | None:
    """Heads with too many turn ids below them and the turns that all their paths share, as a written table; None without any."""
    turns = F.sum((F.size("ids") - F.col("depth")).cast("long"))
    sizes = live.groupBy("head").agg(turns.alias("turns"), F.count(F.lit(1)).alias("n_paths"))
    heads = stored(sizes.where((F.col("turns") > most_turns) & (F.col("n_paths") > 1)).select("head"), "trie-heads")
    if not heads.limit(1).count():
        return None
    bounds = live.join(broadcast_if_small(heads, 48), "head").groupBy("head").agg(
        F.max("depth").alias("depth"), F.min(F.struct("ids", "chars")).alias("low"), F.max("ids").alias("high"))
    # what the least and the greatest path share, all share
    differs = F.array_position(F.zip_with("low.ids", "high", lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(differs > 0, differs - 1).otherwise(F.least(F.size("low.ids"), F.size("high"))).cast("int")
    return stored(bounds.withColumn("shared", shared).select(
        "head", "depth", "shared", F.slice("low.ids", F.lit(1), F.col("shared")).alias("ids"), F.slice("low.chars", F.lit(1), F.col("shared")).alias("chars")),
        "trie-bursts")


def _sorted_for_sweep(held: DataFrame) -> DataFrame:
    return held.repartition("head").sortWithinPartitions("head", "ids")


_SWEPT = ("node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, "
          "ends string, head boolean, round int")
_SWEPT_ARROW = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("head", pa.bool_()), ("round", pa.int32())])


class _Open:
    """A node on the path being swept."""

    __slots__ = ("prefix", "depth", "chars", "conv_id", "n", "children", "leaves", "saved", "ends")

    def __init__(self, prefix, depth: int, chars: int):
        self.prefix, self.depth, self.chars = prefix, depth, chars
        self.conv_id, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, None

    def add(self, conv_id: int, n: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n += n


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted containers, each emitted when its last path is past; state is one path."""
    out: list[tuple] = []
    stack: list[_Open] = []
    container, last, level, above = None, [], 0, None

    def close(depth: int) -> None:
        """Emit the open nodes deeper than `depth`."""
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            node.saved += (node.n - 1) * node.chars
            node.leaves = node.leaves or 1
            parent = stack[-1] if stack else None
            if parent is not None:
                parent.add(node.conv_id, node.n)
                parent.children += 1
                parent.leaves += node.leaves
                parent.saved += node.saved
            out.append((node.prefix.digest(), parent.prefix.digest() if parent is not None else above, node.depth, node.conv_id, node.n,
                        node.children, node.leaves, node.saved, node.ends, parent is None, level))

    for batch in batches:
        columns = [batch.column(c) for c in ("head", "depth", "ids", "chars", "n", "conv_id", "ends", "round")]
        for i in range(len(batch)):
            head, depth, ids, chars, n, conv_id, ends, step = (c[i].as_py() for c in columns)
            if head != container:
                close(-1)
                container, level, last = head, step, ids[:depth]
                above = hashlib.md5(b"".join(ids[: depth - 1])).digest() if depth else None
                stack.append(_Open(hashlib.md5(b"".join(ids[:depth])), depth, chars[depth - 1] if depth else 0))
            same = depth
            while same < len(last) and same < len(ids) and last[same] == ids[same]:
                same += 1
            close(same)
            for at in range(same, len(ids)):
                prefix = stack[-1].prefix.copy()
                prefix.update(ids[at])
                stack.append(_Open(prefix, at + 1, chars[at]))
            stack[-1].add(conv_id, n)
            stack[-1].ends, last = ends, ids
            if len(out) >= _NODES_PER_BATCH:
                yield _nodes(out)
                out.clear()
    close(-1)
    if out:
        yield _nodes(out)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SWEPT_ARROW)], schema=_SWEPT_ARROW)


# ---- nodes above the containers -----------------------------------------------------------------

_SUMS = ("parent", "conv_id", "n_convs", "n_leaves", "saved")


def _upper_nodes(swept: DataFrame, bursts: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Burst nodes and the chains of shared turns above them, summed from their children, deepest round first."""
    made, tops = [swept.drop("round", "head").limit(0)], None
    for step in reversed(range(len(bursts))):
        big, ended = bursts[step]
        kids = swept.where(F.col("head") & (F.col("round") == step + 1)).select(*_SUMS)
        kids = kids if tops is None else kids.unionByName(tops)
        sums = kids.groupBy(F.col("parent").alias("node")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        summed = big.withColumn("node", node_key(F.col("ids"))).join(sums, "node").join(ended, "node", "left").select(
            "depth", "ids", "chars", F.least("conv_id", "own_id").alias("conv_id"), (F.col("n_convs") + F.coalesce("own_n", F.lit(0))).alias("n_convs"),
            "n_children", "n_leaves", "saved", "ends")
        chain = stored(summed.mapInArrow(_chain, _SWEPT), "trie-upper")
        made.append(chain.drop("round", "head"))
        tops = chain.where("head").select(*_SUMS)
    return reduce(DataFrame.unionByName, made)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes from the head of a burst container down to its burst node, whose sums are given."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, chars, depth = row["ids"], row["chars"], row["depth"]
            prefix = hashlib.md5(b"".join(ids[: max(depth - 1, 0)]))
            keys = [prefix.digest()] if depth else [None, prefix.digest()]
            for at in range(max(depth - 1, 0), len(ids)):
                prefix.update(ids[at])
                keys.append(prefix.digest())
            out, saved = [], row["saved"]
            for at in range(len(ids), depth - 1, -1):
                saved += (row["n_convs"] - 1) * (chars[at - 1] if at else 0)
                last = at == len(ids)
                out.append((keys[at - depth + 1], keys[at - depth], at, row["conv_id"], row["n_convs"], row["n_children"] if last else 1,
                            row["n_leaves"], saved, row["ends"] if last else None, at == depth, -1))
            yield _nodes(out)


# ---- members that end at a node -----------------------------------------------------------------

def ends_digest(members: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of the ids of members(node, conv_id), ascending and joined by commas.

    Ids are joined to chunks in ranges of (node, conv_id), so a node with very
    many members is spread over tasks; its chunks are then hashed in order as a stream.
    """
    chunks = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _joined_ids, "node binary, first bigint, ids string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed_chunks, "node binary, ends string")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        for start in range(0, len(batch), _IDS_PER_CHUNK):
            part = batch.slice(start, _IDS_PER_CHUNK)
            groups: dict[bytes, list[int]] = {}
            for node, conv_id in zip(part.column("node").to_pylist(), part.column("conv_id").to_pylist()):
                groups.setdefault(node, []).append(conv_id)
            texts = [",".join(map(str, ids)) for ids in groups.values()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((list(groups), [v[0] for v in groups.values()], texts), schema)], schema=schema)


def _hashed_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
    node, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((node, digest.hexdigest()), schema)], schema=schema)
