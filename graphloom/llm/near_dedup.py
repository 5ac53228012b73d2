"""Near-duplicate documents by SetSketch banding, joint estimation and exact checks.

1. Every text becomes its set of word shingles (64-bit hashes) and a sketch;
   texts with equal sets are one class from here on.
2. Classes that agree on a band of registers share a bucket.  Inside a bucket,
   classes are compared with a few leaders only, by maximum likelihood: a class
   close to a leader is absorbed, any other becomes a leader, and a class that
   may be similar to a leader is connected with it.  Two classes above the
   threshold end up connected through a leader (Jaccard distance is a metric).
3. Connected classes form clusters of look-alikes; inside a cluster the exact
   sets are compared until every pair of unconnected classes is decided.  A
   cluster too large for one task is compared in parts first; what that leaves
   unconnected meets by shared rare shingles (prefix filter, exact).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import groups, map_arrow
from graphloom.llm.components import connected_components
from graphloom.llm.scratch import materialize
from graphloom.llm.setsketch import REGISTERS, log_likelihood, may_reach, registers, similarity
from graphloom.llm.tokens import chunks, hash_strings, lower_ascii, mix64, words

BAND_ROWS = 6  # registers of a band: 30 bands
BUCKET_ROWS = 20_000  # classes of a bucket (or cluster) compared in one task
STAR_ROWS = 16  # classes of a bucket small enough to be one candidate group unseen
HUBS = 64  # members of a larger bucket that every part of it is compared with first
SLOT_BITS = 18  # slots in which the shingles of large clusters are counted
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def _shingles(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word windows; the whole text if shorter."""
    n = len(word_hash)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(width, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mix64(h * _ODD[i % 5] + word_hash[i : n - k + 1 + i] + np.uint64(i))
    return np.unique(h)


_SKETCH = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("d1", T.LongType()),
    T.StructField("d2", T.LongType()),
    T.StructField("regs", T.BinaryType()),
    T.StructField("shingles", T.BinaryType()),
]
_KEPT_BITS = np.uint64(16)  # a stored set keeps the upper 48 bits of its hashes


def _store(s: np.ndarray) -> bytes:
    """A rising set as the byte planes of its 48-bit steps, those in use only."""
    steps = np.diff(s >> _KEPT_BITS, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T
    used = int(np.flatnonzero(planes.any(1)).max(initial=-1)) + 1
    return bytes([used]) + planes[:used].tobytes()


def _load(data: bytes) -> np.ndarray:
    used = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1)
    n = len(raw) // used if used else 0
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = raw.reshape(used, n).T if n else planes[:, :used]
    return np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64)


def _sketch_task(width: int, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            distinct, index, starts = words(lower_ascii(b.column("text")))
            hashed = hash_strings(distinct)[index]
            n, d1, d2, regs, sets = [], [], [], [], []
            for a, z in zip(starts[:-1].tolist(), starts[1:].tolist()):
                s = _shingles(hashed[a:z], width)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    d1.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)))
                    d2.append(int((mix64(s ^ _ODD[1]) * _ODD[2]).sum(dtype=np.uint64).astype(np.int64)))
                regs.append(registers(s).tobytes() if len(s) else b"")
                sets.append(_store(s))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in carried), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64()), pa.array(regs, pa.binary()), pa.array(sets, pa.binary())],
                names=[*carried, *(f.name for f in _SKETCH)],
            )

    return run


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _central_first(regs: np.ndarray) -> np.ndarray:
    """Order of rows by how many registers agree with the group's commonest values."""
    if len(regs) < 3:
        return np.arange(len(regs))
    mode = np.array([np.bincount(regs[:, i], minlength=256).argmax() for i in range(REGISTERS)], np.uint8)
    return np.argsort(-(regs == mode).sum(1), kind="stable")


def _leaders_task(absorb: float, link: float):
    """Edges that connect a bucket's classes to the leaders they may be similar to
    (fewer than classes); ``left`` marks classes that no hub absorbed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["key", "part"]):
            node = t["node"].to_numpy()
            size, regs = t["n_shingles"].to_numpy(), _matrix(t["regs"])
            hub = t["hub"].to_numpy()
            order = _central_first(regs)
            order = np.concatenate((order[hub[order]], order[~hub[order]]))
            free = ~hub
            comp = np.unique(t["label"].to_numpy(), return_inverse=True)[1]  # what the edges so far connect
            a, b = [], []
            for i in order.tolist():
                if hub.any() and not hub[i]:
                    break
                if not (hub[i] or free[i]):
                    continue  # absorbed: a leader near it stands for it
                free[i] = False
                # what is connected already needs no edge (a hub must look at all to absorb)
                other = np.flatnonzero(np.arange(len(node)) != i if hub.any() else comp != comp[i])
                if not len(other):
                    continue
                ll = log_likelihood(regs[other], size[other], regs[i], int(size[i]))
                near = other[may_reach(ll, link, 8.0)]
                joined, at = np.unique(comp[near], return_index=True)
                for c, k in zip(joined.tolist(), near[at].tolist()):
                    if c != comp[i]:
                        a.append(int(node[i]))
                        b.append(int(node[k]))
                comp[np.isin(comp, joined)] = comp[i]
                free[other[similarity(ll) >= absorb]] = False
            left = node[free & ~hub].tolist() if hub.any() else []
            if not a and not left:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([*a, *left], pa.int64()), pa.array([*b, *left], pa.int64()),
                 pa.array([int(t["key"][0].as_py())] * (len(a) + len(left)), pa.int64()),
                 pa.array([False] * len(a) + [True] * len(left), pa.bool_())],
                names=["a", "b", "key", "left"],
            )

    return run


_EDGES = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("key", T.LongType()), T.StructField("left", T.BooleanType())]
)


def _meeting(rows: DataFrame) -> DataFrame:
    """Deal ``key``, ``label``, ``node`` to tasks (``key``, ``part``) of about
    ``BUCKET_ROWS`` rows, so that any two rows of a key whose labels differ share
    a task.  Rows of one label are known to be connected: the commonest label's
    blocks meet no block of their own, and keys of one label are dropped."""
    weight = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("w"))
    top = weight.groupBy("key").agg(F.sum("w").alias("n"), F.max(F.struct("w", "label")).alias("top")).where("top.w < n")
    half = max(1, BUCKET_ROWS // 2)
    outer = F.ceil((F.col("n") - F.col("top.w")) / half)
    blocks = top.select(
        "key", F.col("top.label").alias("common"), (F.col("n") <= BUCKET_ROWS).alias("one"),
        outer.alias("outer"), (outer + F.ceil(F.col("top.w") / half)).alias("blocks"),
    )
    chance, common = F.xxhash64(F.lit("block"), "node"), F.col("label") == F.col("common")
    block = F.when(common, F.col("outer") + F.pmod(chance, F.col("blocks") - F.col("outer"))).otherwise(F.pmod(chance, F.col("outer")))
    placed = rows.join(blocks, "key").withColumn("block", F.when(F.col("one"), F.lit(0).cast("long")).otherwise(block))
    others = F.sequence(F.lit(0).cast("long"), F.when(common, F.col("outer")).otherwise(F.col("blocks")) - 1)
    met = F.when(F.col("one"), F.array(F.lit(0).cast("long"))).otherwise(F.array_remove(others, F.col("block")))
    pair = placed.withColumn("other", F.explode(met))
    part = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    return pair.select("key", part.alias("part"), "label", "node")


def _candidate_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """Edges that connect every two classes of one bucket that may be similar.

    A class within ``threshold`` of a leader is absorbed; any class similar to
    it is then at least 2 * threshold - 1 similar to that leader, which is the
    bound (less a margin for the estimate) for keeping an edge.
    """
    absorb, link = threshold + 0.04, 2 * threshold - 1
    band = F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // BAND_ROWS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("regs"), i * BAND_ROWS + 1, F.lit(BAND_ROWS))),
    )
    banded = materialize(classes.select("node", F.explode(band).alias("key")), "bands")
    several = (
        banded.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("sig"))
        .where("n > 1")
        .groupBy("n", "lo", "hi", "sig").agg(F.min("key").alias("key"))  # bands often agree on a whole group
        .withColumn("parts", F.ceil(F.col("n") / BUCKET_ROWS).cast("int"))
    )
    several = materialize(several, "buckets")
    pairs = several.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    members = materialize(
        banded.join(several.where("n > 2").select("key", "n", "lo", "parts"), "key"), "members"
    )
    small = members.where(F.col("n") <= STAR_ROWS).select(F.col("lo").alias("a"), F.col("node").alias("b"))
    ready = pairs.unionByName(small)
    members = members.where(F.col("n") > STAR_ROWS)
    facts = classes.select("node", "n_shingles", "regs")

    def leaders(rows: DataFrame) -> DataFrame:
        full = rows.join(facts, "node").select("key", "part", "label", "hub", "node", "n_shingles", "regs")
        dealt = full.repartition("key", "part").sortWithinPartitions("key", "part", "node")
        return map_arrow(dealt, _leaders_task(absorb, link), _EDGES)

    label = F.col("node").alias("label")
    plain = members.where("parts = 1").select("key", F.lit(0).cast("long").alias("part"), label, F.lit(False).alias("hub"), "node")
    if members.where("parts > 1").isEmpty():
        return ready.unionByName(leaders(plain).select("a", "b"))
    # a large bucket: its parts meet the same hubs first, and what no hub absorbs meets again, two
    # blocks a task, unless the hubs connect it
    hot = members.where("parts > 1")
    chance = F.pmod(F.xxhash64(F.lit("hub"), "key", "node"), F.lit(1 << 30))
    hot = hot.withColumn("hub", chance < F.lit(1 << 30) / F.col("n") * HUBS)
    part = F.pmod(F.xxhash64(F.lit("part"), "node"), F.col("parts"))
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    spread = hot.where("not hub").select("key", part.alias("part"), label, "hub", "node").unionByName(
        hot.where("hub").select("key", every_part.alias("part"), label, "hub", "node")
    )
    first = materialize(leaders(spread), "hub-edges")
    roots = connected_components(first.where("not left"))
    left = first.where("left").select("key", F.col("a").alias("node")).join(roots, "node", "left")
    left = materialize(left.select("key", F.coalesce("root", "node").alias("label"), "node"), "left")
    rest = _meeting(left).withColumn("hub", F.lit(False))
    looked = leaders(plain.unionByName(rest)).unionByName(first.where("not left"))
    return ready.unionByName(looked.select("a", "b"))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted sets of distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify_task(percent: int):
    """Verified links (a spanning set) between classes of a cluster part that are
    not connected yet (classes of one label are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["key", "part"]):
            node, size, regs = t["node"].to_numpy(), t["n_shingles"].to_numpy(), _matrix(t["regs"])
            sets = [_load(s) for s in t["shingles"].to_pylist()]
            comp = np.unique(t["label"].to_numpy(), return_inverse=True)[1]
            a, b = [], []

            def against(i: int) -> None:
                other = np.flatnonzero(comp != comp[i])
                if not len(other):
                    return
                ll = log_likelihood(regs[other], size[other], regs[i], int(size[i]))
                for k in other[may_reach(ll, percent / 100)].tolist():
                    if comp[k] != comp[i] and similar(sets[i], sets[k], percent):
                        a.append(int(node[i]))
                        b.append(int(node[k]))
                        comp[comp == comp[k]] = comp[i]

            order = _central_first(regs)
            for i in order[:HUBS].tolist():  # the middle of the cluster connects most of it
                against(i)
            # two classes of one component need no look: every other pair has one outside the largest
            of = np.argmax(comp == np.bincount(comp).argmax())
            for i in order.tolist():
                if comp[i] != comp[of]:
                    against(i)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _slots(s: np.ndarray) -> np.ndarray:
    return (mix64(s) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


_SLOT_COUNTS = T.StructType([T.StructField("slot", T.LongType()), T.StructField("n", T.LongType())])
_PREFIXES = T.StructType([T.StructField(c, T.LongType()) for c in ("root", "label", "node", "shingle")])


def _slot_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the sets fall in each slot."""
    n = np.zeros(1 << SLOT_BITS, np.int64)
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            sets = [_load(s) for s in b.column("shingles").slice(at, 1000).to_pylist()]
            n += np.bincount(_slots(np.concatenate(sets)), minlength=len(n))
    slot = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(n[slot])], names=["slot", "n"])


def _prefix_task(percent: int, level: np.ndarray):
    """The shingles of each set that come first, rare before common ones: as many
    as it takes that sets above the threshold share one of them, whatever the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                rows = b.slice(at, 1000)
                firsts = []
                for data in rows.column("shingles").to_pylist():
                    s = _load(data)
                    order = np.lexsort((s, level[_slots(s)]))
                    firsts.append(s[order[: len(s) - -(-percent * len(s) // 100) + 1]].view(np.int64))
                index = pa.array(np.repeat(np.arange(len(firsts)), [len(f) for f in firsts]))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c).take(index) for c in ("root", "label", "node")), pa.array(np.concatenate(firsts))],
                    names=_PREFIXES.names,
                )

    return run


def _rare_lists(labelled: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``key``, ``label``, ``node``: classes of a cluster (``root``) by the shingles of
    their prefixes, lists of one label left out and lists of equal members but one."""
    full = labelled.join(classes, "node").select("root", "label", "node", "shingles")
    counts = map_arrow(full.select("shingles"), _slot_task, _SLOT_COUNTS).groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    level = np.zeros(1 << SLOT_BITS, np.uint8)  # doublings of a slot's count: any order is right, rare first keeps lists short
    level[counts["slot"].to_numpy()] = np.log2(counts["n"].to_numpy()).astype(np.uint8)
    prefixes = map_arrow(full, _prefix_task(percent, level), _PREFIXES)
    lists = materialize(prefixes.select(F.xxhash64("root", "shingle").alias("key"), "label", "node"), "prefixes")
    several = (
        lists.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"),
            F.bit_xor(F.xxhash64("node")).alias("sig"), F.min("label").alias("first"), F.max("label").alias("last"),
        )
        .where("first <> last")
        .groupBy("n", "lo", "hi", "sig").agg(F.min("key").alias("key"))
    )
    return materialize(lists.join(several.select("key"), "key", "left_semi"), "lists")


def _verified_links(clusters: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links above the threshold that connect each cluster (``node``, ``root``) as
    all its links would."""
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    sized = materialize(
        clusters.join(sizes, "root").withColumn("parts", F.ceil(F.col("n") / BUCKET_ROWS)), "clusters"
    )

    def verify(rows: DataFrame) -> DataFrame:
        full = rows.join(classes, "node").select("key", "part", "label", "node", "n_shingles", "regs", "shingles")
        dealt = full.repartition("key", "part").sortWithinPartitions("key", "part", "node")
        return map_arrow(dealt, _verify_task(percent), _LINKS)

    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    part = F.pmod(F.xxhash64(F.lit("part"), "node"), F.col("parts")).alias("part")
    key, label = F.col("root").alias("key"), F.col("node").alias("label")
    hub = F.pmod(F.xxhash64(F.lit("hub"), "node"), F.lit(1 << 30)) < F.lit(1 << 30) / F.col("n") * HUBS
    once = sized.where((F.col("parts") == 1) | ~hub).select(key, part, label, "node")
    large = sized.where("parts > 1")
    if large.isEmpty():
        return verify(once)
    # parts of a large cluster share some members, which joins their components
    links = materialize(verify(once.unionByName(large.where(hub).select(key, every_part, label, "node"))), "links")
    # classes not connected yet can be linked only where their prefixes share a shingle
    roots = connected_components(links).select("node", F.col("root").alias("label"))
    labelled = large.join(roots, "node", "left").withColumn("label", F.coalesce("label", "node"))
    undecided = labelled.groupBy("root").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    labelled = materialize(labelled.join(undecided.select("root"), "root").select("root", "label", "node"), "labelled")
    if labelled.isEmpty():
        return links
    return links.unionByName(verify(_meeting(_rare_lists(labelled, classes, percent))))


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, carry: tuple[str, ...] = ()) -> DataFrame:
    """Near-duplicate groups of documents (``doc_id``, ``text``).

    Words are runs of non-white-space after lower-casing A-Z; a document's set
    holds its distinct ``width``-word shingles, or the whole text if shorter.
    Documents are linked when 100 * intersection >= ``percent`` * union, and
    grouped by links.  One row per input row: ``doc_id``, the ``carry`` columns,
    ``n_shingles``, ``component_id`` (smallest id of the group), ``first`` (the
    one row of the group that stands for it: smallest id, then place).  Texts
    without words (null, empty, blank) are groups of their own; null ids sort
    last and only name a group without other ids; repeated rows are one group;
    an empty frame gives an empty frame.  Sets are compared by 48-bit hashes.
    """
    row = "_llm_row"
    carried = [row, "doc_id", *carry]
    named = docs.select(F.monotonically_increasing_id().alias(row), "doc_id", "text", *carry)
    schema = T.StructType([named.schema[c] for c in carried] + _SKETCH)
    sets = materialize(map_arrow(named, _sketch_task(width, carried), schema), "sketches")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    merged = materialize(
        sets.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min(place).alias("place"))
        .withColumn("node", F.col(f"place.{row}")), "classes",
    )
    reps = sets.where("n_shingles > 0").select(F.col(row).alias("node"), "n_shingles", "regs", "shingles")
    classes = reps.join(merged.select("node"), "node", "left_semi")
    edges = _candidate_edges(materialize(classes.drop("shingles"), "representatives"), percent / 100)
    clusters = materialize(connected_components(edges), "candidates")
    links = _verified_links(clusters, classes, percent)
    roots = connected_components(links)
    rooted = merged.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min("place").alias("first_place"))
    named_groups = materialize(
        rooted.join(firsts, "root").select("d1", "d2", "n_shingles", "first_place"), "groups"
    )
    out = sets.select(*carried, "n_shingles", "d1", "d2").join(named_groups, ["d1", "d2", "n_shingles"], "left")
    stands = F.col(f"first_place.{row}") == F.col(row)
    return out.select(
        "doc_id",
        *carry,
        "n_shingles",
        F.when(F.col("first_place").isNull(), F.col("doc_id")).otherwise(F.col("first_place.doc_id")).alias("component_id"),
        F.coalesce(stands, F.lit(True)).alias("first"),
    )
