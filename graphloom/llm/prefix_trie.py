"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

1. A conversation is the sequence of its turns' digests (equal role and text,
   equal digest).  Equal sequences are one row from here on, with their member
   count and smallest id, so a sequence that many conversations share is small.
2. The distinct sequences are sorted into ranges.  Inside a range, neighbours
   are joined by an edge as deep as their longest common prefix (LCP); a
   union-find takes the edges in descending depth.  Every merge creates (or
   widens) the branching node of that depth, and the turns between two
   branching nodes are the nodes of unary chains.
3. Only prefixes of a range's first or last sequence can reach into another
   range.  They are contracted to one row each; equal prefixes are merged over
   all ranges and summed up along the tree in one pass that holds a path.
4. What ends at a node is hashed from blocks of sorted ids, so a sequence with
   very many members is never held whole.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.scratch import materialize
from graphloom.session import shuffle_partitions

TURNS_PER_RANGE = 400_000  # turns of distinct sequences that one task sorts and merges
LEAST_SPLIT = 20  # a smaller table still makes ranges of this fraction of it, up to the shuffle partitions
BLOCK_IDS = 4096  # ids of one sequence joined to a text at a time
_HEX = 32  # characters of a turn's digest in a key
_STEP = _HEX + 16  # ... and of its size in bytes behind it
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """Digest of one turn; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(``conv_id``, ``turns``): the turns in order (null turn first, ties by
    digest), each as its digest and its text's size in hexadecimal.

    Null roles and texts are empty.  Rows without a conversation id belong to
    no conversation.  48 bytes stand for a turn, whatever its text.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    size = F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 16, "0")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("t"), F.concat(turn_digest(role, text), size).alias("d")).alias("turn"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.col("turns.d").alias("turns"))


def rebuilt(lists: DataFrame, *, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c behind the first h turns of conversation
    c - c % ``family`` (all if fewer, none if absent), h = crc32(c) % ``heads``;
    of its own turns those after the first h stay."""
    own = lists.select(
        "conv_id",
        "turns",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"),
    )
    head = lists.select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    none = F.array().cast("array<string>")
    first = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.greatest("h", F.lit(1)))).otherwise(none)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(head, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


# what ends at a node --------------------------------------------------------------
_BLOCK = T.StructType([T.StructField("key", T.StringType()), T.StructField("low", T.LongType()), T.StructField("ids", T.StringType())])
_ENDS = T.StructType([T.StructField("key", T.StringType()), T.StructField("ends_sha256", T.StringType())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) rows as texts of up to ``BLOCK_IDS`` ids of one key."""
    for b in batches:
        keys, ids = b.column("key").to_numpy(zero_copy_only=False), b.column("conv_id").to_numpy()
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
        run = np.flatnonzero(new)
        within = np.arange(len(keys)) - np.repeat(run, np.diff(np.append(run, len(keys))))
        cut = np.flatnonzero(within % BLOCK_IDS == 0).tolist()
        texts = [",".join(map(str, ids[a:z].tolist())) for a, z in zip(cut, [*cut[1:], len(keys)])]
        yield pa.RecordBatch.from_arrays([pa.array(keys[cut], pa.string()), pa.array(ids[cut]), pa.array(texts, pa.string())], names=_BLOCK.names)


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One running hash per key over its blocks in order."""
    current, state = None, None
    for b in batches:
        keys, out = [], []
        for key, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if key != current:
                if state is not None:
                    keys.append(current)
                    out.append(state.hexdigest())
                current, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], names=_ENDS.names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([state.hexdigest()], pa.string())], names=_ENDS.names)


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of every key's ids in numerical order, comma-joined."""
    ordered = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = map_arrow(ordered, _blocks, _BLOCK)
    return map_arrow(blocks.repartition("key").sortWithinPartitions("key", "low"), _hash_blocks, _ENDS)


# one range --------------------------------------------------------------------------
_SPINE = [
    T.StructField("part", T.IntegerType()),
    T.StructField("spot", T.IntegerType()),  # place on the range's spine; null: not on it
    T.StructField("up", T.IntegerType()),  # the parent's place, where the parent is on the spine
    T.StructField("prefix", T.StringType()),  # digest of a spine node's whole prefix
    T.StructField("size", T.LongType()),
]
_NODE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [T.StructField("ends_sha256", T.StringType())]
    + _SPINE
)


class Forest:
    """The trie nodes of one range of sorted distinct sequences.

    ``depth``, ``lcp``: length of each sequence and of its common prefix with
    the one before (-1 for the first, whose nodes start at the root);
    ``size``: size of every turn that is not shared with the sequence before,
    the root's (0) first.  A sequence owns the nodes of the depths lcp+1 to depth.
    """

    def __init__(self, depth: list[int], lcp: list[int], count: list[int], low: list[int], size: list[int]):
        self.depth, self.lcp, self.size = depth, lcp, size
        owned = np.asarray(depth, np.int64) - np.asarray(lcp, np.int64)
        self.offset = np.concatenate(([0], np.cumsum(owned))).tolist()
        n = self.offset[-1]
        self.n, self.low, self.kids, self.leaves, self.saved = ([0] * n for _ in range(5))
        self.parent = [-1] * n
        self.spine = self._spine()
        self.place = {node: i for i, node in enumerate(self.spine)}
        self._merge(count, low)

    def at(self, owner: int, depth: int) -> int:
        return self.offset[owner] + depth - self.lcp[owner] - 1

    def _spine(self) -> list[int]:
        """Prefixes of the first sequence, then the other prefixes of the last, by depth."""
        first = list(range(self.offset[1]))
        last: list[int] = []
        reach = self.depth[-1]
        for i in range(len(self.depth) - 1, 0, -1):
            if self.lcp[i] < reach:
                last.extend(self.at(i, d) for d in range(reach, self.lcp[i], -1))
                reach = self.lcp[i]
        return first + last[::-1]

    def _climb(self, node: int, below: int) -> int:
        """Close a chain: from ``node`` (complete but for its own turn) up to and
        including the ``below``-th node above it; returns the last closed node."""
        n, low = self.n[node], self.low[node]
        while True:
            if node not in self.place:
                if not self.kids[node]:
                    self.leaves[node] = 1
                self.saved[node] += (n - 1) * self.size[node]
            if below == 0:
                return node
            self.parent[node] = node - 1
            up = node - 1
            self.n[up], self.low[up] = n, low
            self._hang(node, up)
            node, below = up, below - 1

    def _hang(self, node: int, up: int) -> None:
        if node not in self.place:  # what is on the spine is added up over all ranges
            self.kids[up] += 1
            self.leaves[up] += self.leaves[node]
            self.saved[up] += self.saved[node]

    def _merge(self, count: list[int], low: list[int]) -> None:
        k = len(self.depth)
        top = list(self.depth)  # depth of the node that stands for a component, by leftmost sequence
        left = list(range(k))  # union-find towards the leftmost sequence of a component
        for i in range(k):
            node = self.at(i, top[i])
            self.n[node], self.low[node] = count[i], low[i]

        def find(x: int) -> int:
            while left[x] != x:
                left[x] = left[left[x]]
                x = left[x]
            return x

        edges = np.argsort(-np.asarray(self.lcp[1:], np.int64), kind="stable") + 1
        for i in edges.tolist():
            d, a = self.lcp[i], find(i - 1)
            if top[a] > d:  # a new branching node above the chain of the left component
                child = self._climb(self.at(a, top[a]), top[a] - d - 1)
                node = self.at(a, d)
                self.n[node], self.low[node] = self.n[child], self.low[child]
                self.parent[child] = node
                self._hang(child, node)
                top[a] = d
            node = self.at(a, d)
            child = self._climb(self.at(i, top[i]), top[i] - d - 1)
            self.parent[child] = node
            self._hang(child, node)
            self.n[node] += self.n[child]
            self.low[node] = min(self.low[node], self.low[child])
            left[i] = a
        self._climb(self.at(0, top[0]), top[0])


def _common(a: str, b: str) -> int:
    """Turns at the start of both keys."""
    n = min(len(a), len(b)) // _STEP
    lo, hi = 0, n
    while lo < hi:  # the first step that differs
        mid = (lo + hi + 1) // 2
        if a[: mid * _STEP] == b[: mid * _STEP]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _range_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    depth: list[int] = []
    lcp: list[int] = []
    count: list[int] = []
    low: list[int] = []
    ends: list[str] = []
    sizes: list[int] = []
    first, prior = None, ""
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("turns", "n", "low", "ends_sha256")]
        for key, n, smallest, end in zip(*cols):
            shared = _common(prior, key) if depth else -1
            length = len(key) // _STEP
            sizes.extend(int(key[d * _STEP - 16 : d * _STEP], 16) if d else 0 for d in range(shared + 1, length + 1))
            depth.append(length)
            lcp.append(shared)
            count.append(n)
            low.append(smallest)
            ends.append(end)
            first, prior = key if first is None else first, key
    if not depth:
        return
    f = Forest(depth, lcp, count, low, sizes)
    total = f.offset[-1]
    lowest, parent = np.asarray(f.low, np.int64), np.asarray(f.parent, np.int64)
    owner = np.repeat(np.arange(len(depth)), np.diff(f.offset))
    level = np.arange(total) - np.asarray(f.offset[:-1])[owner] + np.asarray(lcp)[owner] + 1
    spot = np.full(total, -1, np.int64)
    spot[f.spine] = np.arange(len(f.spine))
    known = parent >= 0
    up = np.where(known, spot[parent], -1)
    above = lowest[parent]
    end = np.full(total, "", object)
    end[np.asarray(f.offset[1:]) - 1] = ends
    prefix = np.full(total, None, object)
    for node in f.spine:
        key = first if owner[node] == 0 else prior
        prefix[node] = hashlib.md5(key[: int(level[node]) * _STEP].encode()).hexdigest()
    step = 50_000
    for a in range(0, total, step):
        s = slice(a, a + step)
        on = spot[s] >= 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lowest[s]),
                pa.array(level[s]),
                pa.array(above[s], mask=on | ~known[s] | (up[s] >= 0)),
                pa.array(f.n[s], pa.int64()),
                pa.array(f.kids[s], pa.int64()),
                pa.array(f.leaves[s], pa.int64()),
                pa.array(f.saved[s], pa.int64()),
                pa.array([x or None for x in end[s]], pa.string()),
                pa.array(np.full(len(on), part, np.int32)),
                pa.array(spot[s].astype(np.int32), mask=~on),
                pa.array(up[s].astype(np.int32), mask=up[s] < 0),
                pa.array(prefix[s], pa.string()),
                pa.array(f.size[s], pa.int64()),
            ],
            names=_NODE.names,
        )


# across ranges ------------------------------------------------------------------------
_MERGED = T.StructType(
    [T.StructField("prefix", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [T.StructField("ends_sha256", T.StringType())]
)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine nodes in order of their prefixes: every node's subtree is complete when
    a node that is not deeper follows.  Only the path to the current node is held."""
    path: list[dict] = []
    out: list[dict] = []

    def close() -> None:
        node = path.pop()
        node["n_leaves"] = node["n_leaves"] or 1  # no child brought a leaf: a leaf itself
        node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("size")
        if path:
            up = path[-1]
            node["parent_conv_id"] = up["conv_id"]
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
        out.append(node)

    def batch() -> pa.RecordBatch:
        cols = [pa.array([r.get(f.name) for r in out], pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in _MERGED]
        return pa.RecordBatch.from_arrays(cols, names=_MERGED.names)

    for b in batches:
        for node in b.to_pylist():
            while path and path[-1]["depth"] >= node["depth"]:
                close()
            path.append(node)
        if out:
            yield batch()
            out.clear()
    while path:
        close()
    if out:
        yield batch()


def _merged_spines(found: DataFrame) -> DataFrame:
    spine = found.where(F.col("spot").isNotNull())
    equal = spine.groupBy("prefix").agg(
        F.min(F.struct("part", "spot")).alias("at"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("size").alias("size"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    ordered = equal.repartition(1).sortWithinPartitions("at").drop("at")
    return map_arrow(ordered, _sum_up, _MERGED)


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(lists: DataFrame, *, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """The prefix trie of sequences ``lists`` (``conv_id`` long, unique; ``turns``:
    array of 48-character steps, see :func:`turn_lists`).

    One row per distinct prefix, the empty one (the root) included: ``conv_id``
    (its smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of its
    subtree, itself included), ``saved_tokens`` (over its subtree: members but
    one, times the size of the node's last turn) and ``ends_sha256`` (hash of
    the ids that end here, in numerical order, comma-joined).

    Sequences without turns end at the root; equal sequences end at one node; no
    sequence, no row.  A sequence is one row of 48 bytes a turn.  The one task
    that joins the ranges reads at most two paths of each range and holds one.
    """
    keyed = lists.select("conv_id", F.array_join("turns", "").alias("turns"), F.size("turns").cast("long").alias("len"))
    keyed = materialize(keyed.withColumn("key", F.md5(F.col("turns").cast("binary"))), "trie-input")
    distinct = keyed.groupBy("key", "turns", "len").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    sequences = materialize(distinct.join(_ends(keyed.select("key", "conv_id")), "key"), "trie-sequences")
    turns = sequences.agg(F.sum(F.col("len") + 1)).first()[0] or 0
    spread = min(shuffle_partitions(lists.sparkSession), -(-turns * LEAST_SPLIT // turns_per_range))
    ranges = max(1, spread, -(-turns // turns_per_range))
    ordered = sequences.select("turns", "n", "low", "ends_sha256").repartitionByRange(ranges, "turns").sortWithinPartitions("turns")
    found = materialize(map_arrow(ordered, _range_task, _NODE), "trie-nodes")
    spines = materialize(_merged_spines(found), "trie-spines")
    # a node below a spine node learns its parent's smallest member
    places = found.where(F.col("spot").isNotNull()).select("part", F.col("spot").alias("up"), "prefix")
    parents = places.join(spines.select("prefix", F.col("conv_id").alias("_up_id")), "prefix").drop("prefix")
    inner = found.where(F.col("spot").isNull())
    below = inner.where(F.col("up").isNotNull()).join(parents, ["part", "up"]).withColumn("parent_conv_id", F.col("_up_id"))
    nodes = inner.where(F.col("up").isNull()).select(*OUT).unionByName(below.select(*OUT)).unionByName(spines.select(*OUT))
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))


def rebuilt_trie(conversations: DataFrame, *, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """Prefix trie of the rebuilt ``conversations`` (``conv_id``, ``turn``, ``role``,
    ``text``); other columns are ignored, an empty table gives no rows."""
    lists = materialize(turn_lists(conversations), "trie-turns")
    return prefix_trie(rebuilt(lists), turns_per_range=turns_per_range)
