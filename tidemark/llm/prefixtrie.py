"""A trie of conversations by their turns: ternary search trees in range shards, joined where shards meet.

A turn is known by a digest of its role and text, a conversation by its path, the digests of its turns side by side. Paths are
put in order over the cluster, so that a node's members stand together; each shard holds a bounded number of turns, numbers its
turns in the order of digests, and grows a search tree of these numbers. Nodes on the first and the last path of a shard may go
on in the shards beside it: only these are added up between shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, whole_text

#: Bytes of a turn's digest.
WIDE = 16
#: Turns of a shard, and ids that a row of a node's digest text holds.
SHARD_TURNS, CHUNK_IDS = 1 << 18, 1 << 15
#: Conversations whose numbers begin alike up to this one share a base; the base gives at most LENT - 1 turns.
FAMILY, LENT = 100, 6

NODES = (
    "kind string, shard long, key binary, parent_key binary, sides array<int>, conv_id long, parent_conv_id long, depth long, chars long, "
    "n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string, chunk long, ids string"
)
FIELDS = ["kind", "shard", "key", "parent_key", "sides", "conv_id", "parent_conv_id", "depth", "chars", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256", "chunk", "ids"]
KINDS = pa.schema([
    ("kind", pa.string()), ("shard", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("sides", pa.list_(pa.int32())), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("depth", pa.int64()), ("chars", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved", pa.int64()), ("ends_sha256", pa.string()), ("chunk", pa.int64()), ("ids", pa.string()),
])


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, chars): the digests of each rebuilt conversation's turns side by side, and their code points.

    Turns go by number, null first, and by digest where numbers are equal; equal rows are turns of their own.
    """
    role, text = whole_text(F.col("role")), whole_text(F.col("text"))
    # The length of the role parts it from the text.
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("said")
    )
    own = cut(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said")))
    base = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base_id"), F.slice("said", 1, LENT - 1).alias("lent"))
    lent = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int")
    joined = own.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base_id", "left").withColumn("h", lent)
    head = F.coalesce(F.slice("lent", F.lit(1), F.col("h")), F.slice("said", 1, 0))
    said = F.concat(head, F.slice("said", F.col("h") + 1, F.size("said")))
    path = F.unhex(F.array_join(F.transform("said", lambda s: F.hex(s["digest"])), ""))
    return joined.select("conv_id", said.alias("said")).select("conv_id", path.alias("path"), F.col("said.chars").alias("chars"))


class Tree(NamedTuple):
    """A ternary search tree as columns. Every node is a turn behind its parent; node 0 is the root, without a turn."""

    turn: list[int]
    low: list[int]
    equal: list[int]
    high: list[int]
    parent: list[int]
    depth: list[int]


def median_first(n: int) -> Iterator[int]:
    """The places 0 to n - 1, the middle one before those of both halves."""
    waiting = [(0, n)]
    while waiting:
        begin, end = waiting.pop()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            waiting += [(middle + 1, end), (begin, middle)]


def grow(paths: list[np.ndarray]) -> tuple[Tree, list[int]]:
    """The tree of paths of turn numbers, which are in order and differ, and the node where each path ends."""
    tree = Tree([-1], [0], [0], [0], [-1], [0])
    turn, low, equal, high, parent, depth = tree
    ends = [0] * len(paths)
    for k in median_first(len(paths)):
        node = 0
        for number in paths[k].tolist():
            at = equal[node]
            came = None
            while at and turn[at] != number:
                came = at, number < turn[at]
                at = low[at] if came[1] else high[at]
            if not at:
                at = len(turn)
                turn.append(number)
                low.append(0)
                equal.append(0)
                high.append(0)
                parent.append(node)
                depth.append(depth[node] + 1)
                if came is None:
                    equal[node] = at
                else:
                    (low if came[1] else high)[came[0]] = at
            node = at
        ends[k] = node
    return tree, ends


def in_order(tree: Tree) -> list[int]:
    """All nodes, each before its subtree and siblings by their numbers, without recursion."""
    out, waiting = [], [0]
    while waiting:
        at = waiting.pop()
        if at < 0:
            out.append(~at)
            if tree.equal[~at]:
                waiting.append(tree.equal[~at])
            continue
        # Popped in the order low, the node with what is behind it, high.
        if tree.high[at]:
            waiting.append(tree.high[at])
        waiting.append(~at)
        if tree.low[at]:
            waiting.append(tree.low[at])
    return out


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def shard_rows(shard: int, paths: list[bytes], chars: list[np.ndarray], members: list[np.ndarray], chunk_ids: int = CHUNK_IDS) -> list[tuple]:
    """The nodes of one shard: kind "inner" are whole, "edge" may go on in other shards, "ends" are ids for an edge's digest.

    paths are in order and differ; chars are the code points of their turns, members their conversations in rising order.
    """
    # Bytes of one width compare as the paths do; equal digests get one number.
    _, numbers = np.unique(np.frombuffer(b"".join(paths), dtype=f"S{WIDE}"), return_inverse=True)
    begins = np.cumsum([0] + [len(p) // WIDE for p in paths])
    tree, ends = grow([numbers[a:b] for a, b in zip(begins[:-1], begins[1:])])
    size = len(tree.turn)
    n, least, leaves, children, length = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    own: list[np.ndarray | None] = [None] * size
    sides: list[set[int]] = [set() for _ in range(size)]
    key_of: dict[int, bytes] = {}
    for k, end in enumerate(ends):
        n[end], least[end], own[end] = len(members[k]), int(members[k][0]), members[k]
        at, d = end, tree.depth[end]
        while d and not length[at]:
            length[at] = int(chars[k][d - 1]) or -1
            at, d = tree.parent[at], d - 1
    length = [max(x, 0) for x in length]
    for side, k in ((0, 0), (1, len(paths) - 1)):
        trail = [ends[k]]
        while trail[-1]:
            trail.append(tree.parent[trail[-1]])
        hashed = hashlib.md5()
        for d, at in enumerate(reversed(trail)):
            hashed.update(paths[k][(d - 1) * WIDE : d * WIDE] if d else b"")
            key_of[at] = hashed.digest()
            sides[at].add(side)
    order = in_order(tree)
    saved = [0] * size
    for at in reversed(order):
        edge, up = bool(sides[at]), tree.parent[at]
        if not edge:
            leaves[at] += children[at] == 0
            saved[at] += (n[at] - 1) * length[at]
        if up >= 0:
            n[up] += n[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
            # What an edge adds to the nodes above is known when all shards are added up.
            if not edge:
                leaves[up] += leaves[at]
                saved[up] += saved[at]
                children[up] += 1
    rows = []
    for at in order:
        up = tree.parent[at]
        on_edge = up >= 0 and bool(sides[up])
        if sides[at]:
            rows.append(("edge", shard, key_of[at], key_of.get(up), sorted(sides[at]), least[at], None, tree.depth[at], length[at], n[at], children[at], leaves[at], saved[at], None, None, None))
            for c, k in enumerate(range(0, 0 if own[at] is None else len(own[at]), chunk_ids)):
                rows.append(("ends", shard, key_of[at], None, None, None, None, None, None, None, None, None, None, None, c, _joined(own[at][k : k + chunk_ids])))
        else:
            digest = hashlib.sha256(b"" if own[at] is None else _joined(own[at]).encode()).hexdigest()
            rows.append((
                "inner", shard, None, key_of[up] if on_edge else None, None, least[at], None if on_edge else least[up], tree.depth[at], length[at], n[at], children[at],
                leaves[at], saved[at], digest, None, None,
            ))
    return rows


def _shards(paths: DataFrame, shard_turns: int, chunk_ids: int) -> DataFrame:
    """The nodes of all shards; a shard is a stretch of at most about shard_turns turns of the ordered paths."""
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").withColumn("task", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars, members, turns, number = [], [], [], 0, 0

        def shown(shard: int) -> Iterator[pa.RecordBatch]:
            rows = shard_rows(shard, held, chars, [np.concatenate(m) for m in members], chunk_ids)
            for k in range(0, len(rows), 1 << 14):
                yield pa.RecordBatch.from_pydict(dict(zip(FIELDS, map(list, zip(*rows[k : k + (1 << 14)])))), schema=KINDS)

        task = 0
        for batch in batches:
            ids, task = batch.column("conv_id").to_numpy(), batch.column("task")[0].as_py()
            column = batch.column("path").to_pylist()
            begins = [k for k, p in enumerate(column) if not k or p != column[k - 1]] + [len(column)]
            for begin, end in zip(begins[:-1], begins[1:]):
                path = column[begin]
                if turns > shard_turns:
                    yield from shown((task << 32) + number)
                    held, chars, members, turns, number = [], [], [], 0, number + 1
                if not held or held[-1] != path:
                    held.append(path)
                    chars.append(np.array(batch.column("chars")[begin].as_py(), np.int64))
                    members.append([])
                    turns += len(path) // WIDE
                members[-1].append(ids[begin:end])
                # Each conversation counts as a turn, so that copies of one path are shared out too.
                turns += end - begin
        if held:
            yield from shown((task << 32) + number)

    return ordered.mapInArrow(run, NODES)


def _edge_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes whose ids may stand in several shards; the ids of a node go by in order and are not kept."""
    dealt = ends.select("key", "shard", "chunk", "ids").repartition("key").sortWithinPartitions("key", "shard", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hashed = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if key != at:
                    if at is not None:
                        out.append((at, hashed.hexdigest()))
                    at, hashed = key, hashlib.sha256()
                else:
                    hashed.update(b",")
                hashed.update(ids.as_py().encode())
            if out:
                yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in out], pa.binary()), "ends_sha256": [d for _, d in out]})
        if at is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([at], pa.binary()), "ends_sha256": [hashed.hexdigest()]})

    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first (see rebuilt_paths): the head of h = crc32(conv_id) mod 6 turns is that of conversation
    conv_id - conv_id mod 100. A node is a sequence of turns that rebuilt conversations begin with; conv_id is its smallest
    member, saved_tokens the code points that its subtree's turns would take up again in every member but one.

    Null role and text are empty, turns without a number come first, turns of one number follow each other by digest, and
    repeated rows are turns of their own. Rows without conv_id belong to no conversation. A conversation may be left without
    turns: it is a member of the root, and ends there. An empty table has no nodes, not even a root. Only conv_id, turn, role
    and text are read, so other columns may have any name.

    The turns of one conversation are gathered in one row (WIDE bytes each, no text). Copies of a path are dealt out
    by their ids. What shards have in common, two paths each, is joined as tables; the ids of a node that many conversations
    end at pass one task, as a digest of all of them demands, but as text in order, with nothing kept.
    """
    nodes = cut(_shards(rebuilt_paths(conversations), shard_turns, chunk_ids))
    edges = nodes.where("kind = 'edge'")
    merged = edges.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("chars").alias("chars"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"), F.sum("saved").alias("inner_saved"),
        F.min(F.struct("shard", F.element_at("sides", 1).alias("side"))).alias("owner"),
    )
    # An edge's children are those that no other shard has, and the edges behind it, each of them once.
    behind = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("edges"))
    merged = merged.join(behind, "key", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("edges", F.lit(0)))
    merged = merged.withColumn("leaves", F.col("inner_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
    merged = cut(merged.withColumn("saved", F.col("inner_saved") + (F.col("n_convs") - 1) * F.col("chars")))

    # Every edge belongs to the first or last path of one shard; sums run up these paths, and each node adds up its own.
    trails = edges.select("key", "shard", "depth", F.explode("sides").alias("side")).join(merged.select("key", "owner", "leaves", "saved"), "key")
    upwards = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))

    def owned(column: str) -> Column:
        return F.sum(F.when(F.col("owner") == F.struct("shard", "side"), F.col(column)).otherwise(0)).over(upwards)

    summed = trails.select("key", owned("leaves").alias("leaves"), owned("saved").alias("saved"))
    totals = summed.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("edge_parent"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = merged.join(totals, "key").join(_edge_digests(nodes.where("kind = 'ends'")), "key", "left").join(parents, "parent_key", "left")
    whole = whole.withColumn("parent_conv_id", F.col("edge_parent")).withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    inner = nodes.where("kind = 'inner'").withColumnRenamed("saved", "saved_tokens")
    below = inner.where("parent_key IS NOT NULL").drop("parent_conv_id").join(parents.withColumnRenamed("edge_parent", "parent_conv_id"), "parent_key")
    return whole.select(*shown).unionByName(below.select(*shown)).unionByName(inner.where("parent_key IS NULL").select(*shown))
