"""Pregel as a loop of Catalyst-planned DataFrame jobs.

Layout.  With ``P = spark.sql.shuffle.partitions``:

* the edges are written once under the session's checkpoint directory as a
  Parquet table bucketed on ``src`` into ``P`` buckets;
* the vertex state of every superstep is a Parquet table **bucketed on id
  into P buckets**, written under the session's checkpoint directory.  Spark
  hashes buckets exactly as it hashes shuffle partitions, so state, frontier
  and edges are co-partitioned.

Each superstep is then

1. **frontier join** -- the vertices that changed last round (a filter on the
   bucketed state) meet their out-edges partition by partition (a merge join
   without any exchange: neither the edges nor the frontier move).  A frontier
   of few vertices is pushed into the edge scan as an ``IN`` filter, which
   skips the other buckets and, the buckets being sorted, most row groups.
   Sources with more edges than an average partition ("hubs", at most ``P``)
   keep their edges in a separate, round-robin spread set and meet their
   frontier rows through a broadcast of at most ``P`` rows, so a vertex with
   a third of all edges never lands in one task.
2. **send** -- one message column per edge; NULL means "no message".
3. **merge** -- ``groupBy(dst).agg(merge)``: the only shuffle of the round,
   after partial aggregation, so a vertex receiving a third of all messages
   is already combined map-side.
4. **update** -- the merged messages meet the receivers' current state; the
   merge output is hash-partitioned into the same ``P`` partitions, so the
   state does not move either.

A run that is given a name leaves a manifest beside its tables after every round
and can be resumed from there after its driver was lost.

The state is log-structured: a base table with all vertices and a few deltas
with the rows that changed since, all bucketed alike, the newest last.  A round
writes the rows that changed (and takes over deltas that are not larger, so
their number stays small); where that would come near the number of vertices, or
where the vertices are few anyway, it writes a new base instead.  Every table survives the loss of any executor, and
its counters are observed during the write.  ``fuse`` runs several supersteps in
one query, which saves writes but computes each earlier superstep once per
branch that reads it; fused rounds write bases.
"""
from __future__ import annotations

import json
import logging
import math
import re
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.graph import PropertyGraph
from graphloom.operators.joins import not_null
from graphloom.session import checkpoint_dir, on_release, shuffle_partitions

DIRECTIONS = ("out", "in", "either")

PUSH_IDS = 200  # a frontier of at most this many vertices is pushed into the edge scan
PUSH_EDGES = 1_000_000  # ... of an edge table of at least this many edges
MAX_DELTAS = 4  # delta tables a superstep reads beside the base
BASE_ROWS = 100_000  # a base of at most this many vertices is written anew rather than read with deltas
BASE_SHARE = 2  # rows to write that are more than 1 / this of all vertices make a new base

_log = logging.getLogger(__name__)
_OPEN: list["_StateStore"] = []  # runs whose final state has not been released


def release_states(spark) -> None:
    """Drop the final state of every run that was not released (their results
    can no longer be read)."""
    while _OPEN:
        _OPEN[-1].drop_all()


on_release(release_states)


@dataclass(frozen=True)
class VertexProgram:
    """The three user functions of Pregel, as Column builders (no Python UDF).

    * ``send(state)`` -> message column, evaluated per edge of an active vertex
      over columns ``src``, ``dst``, the edge properties and the active vertex's
      state; the message goes to the other end.  NULL = no message.
    * ``merge(msg)`` -> aggregate column; must be commutative and associative.
    * ``update(state, msg)`` -> new state; only called where a message arrived.
    * ``send_triplet(src_state, dst_state)``, if given, replaces ``send`` and may
      read both ends' states: its edges then meet the state once more.
    * ``send_all(src_state, dst_state)``, if given, replaces both: an array of any
      number of messages to either end (see :func:`messages`).
    * ``active_on``: which vertices send in the next round, those whose state
      ``"changed"`` or all that ``"received"`` a message (for sums and counts).
    """

    send: Callable[[Column], Column] | None
    merge: Callable[[Column], Column]
    update: Callable[[Column, Column], Column]
    send_triplet: Callable[[Column, Column], Column] | None = None
    send_all: Callable[[Column, Column], Column] | None = None
    active_on: str = "changed"

    def __post_init__(self) -> None:
        if self.active_on not in ("changed", "received"):
            raise ValueError("active_on must be 'changed' or 'received'")


def messages(*, to_src: Column | None = None, to_dst: Column | None = None) -> Column:
    """Messages of one edge for ``send_all``; a NULL message is not sent."""
    sent = [(F.col("src"), to_src), (F.col("dst"), to_dst)]
    made = F.array(*[F.struct(target.alias("id"), msg.alias("msg")) for target, msg in sent if msg is not None])
    return F.filter(made, lambda m: m["msg"].isNotNull())


_TRACE_SCHEMA = T.StructType(
    [
        T.StructField("superstep", T.IntegerType(), False),
        T.StructField("active", T.LongType(), False),
        T.StructField("messages", T.LongType(), False),
        T.StructField("receivers", T.LongType(), False),
        T.StructField("changed", T.LongType(), False),
        T.StructField("seconds", T.DoubleType(), False),
    ]
)


@dataclass
class PregelResult:
    vertices: DataFrame  # id, state
    rounds: int
    converged: bool
    trace: DataFrame  # superstep, active, messages, receivers, changed, seconds
    edge_stats: Row | None = None
    edges: DataFrame | None = None  # the written edges, with ``keep_edges``
    settled: DataFrame | None = None  # id, state, since: the superstep of its last change
    _store: "_StateStore | None" = field(default=None, repr=False)

    def release_edges(self) -> None:
        """Drop the edges that ``keep_edges`` left, if any."""
        if self._store is not None:
            for key in [k for k in self._store.tables if k.startswith("edges")]:
                self._store.drop(key)
        self.edges = None

    def release(self) -> None:
        """Drop the written edge sets and state (after this ``vertices`` can
        no longer be read)."""
        if self._store is not None:
            self._store.drop_all()
            self._store = None


@dataclass(frozen=True)
class Progress:
    """A run after one of its rounds."""

    rounds: int
    vertex_count: int
    edge_stats: Row
    settled: DataFrame  # id, state, since
    edges: DataFrame  # the written edges
    store: "_StateStore"  # tables written with it are dropped with the run


@dataclass
class _Edges:
    key: str  # "src" or "dst": the end whose vertex is active
    cold: DataFrame  # bucketed on the key into P buckets
    hot: DataFrame | None  # hubs' edges, read by file splits
    hubs: list  # at most P ids
    stats: Row

    @property
    def other(self) -> str:
        return "dst" if self.key == "src" else "src"


def _edge_stats(e: DataFrame, min_columns: tuple[str, ...]) -> tuple[Row, DataFrame]:
    """Edge count, largest degrees and, for each column in ``min_columns``, its
    minimum and NULL count; plus the degrees per id.  Only used when endpoints are
    not filled (the vertex table gives them otherwise)."""
    per = _vertex_table(e.select(F.col("src").alias("id")).limit(0), e, min_columns)
    return per.agg(*_stat_columns(min_columns)).first(), per.select("id", "_deg", "_indeg")


def _stat_columns(min_columns: tuple[str, ...]) -> list[Column]:
    """The statistics of all edges from the vertex table's columns."""
    return [
        F.sum("_deg").alias("edges"),
        F.max("_deg").alias("max_out_degree"),
        F.max("_indeg").alias("max_in_degree"),
        *[F.min(f"_min_{c}").alias(f"min_{c}") for c in min_columns],
        *[F.sum(f"_nulls_{c}").alias(f"nulls_{c}") for c in min_columns],
    ]


def _split_hubs(e: DataFrame, path: str, key: str, stats: Row, degrees: DataFrame, parts: int) -> _Edges:
    """Set hubs apart in one written edge table, bucketed on ``key``.

    A vertex with more edges than an average partition is a hub: at most
    ``parts`` of them exist, so their ids may be literals of a filter.  The
    other edges are read by bucket, co-partitioned with the state; the hubs'
    edges are read from the same files by file split, so their bucket is not
    one task's work.
    """
    threshold = max(1, math.ceil(int(stats["edges"] or 0) / parts))
    degree, most = ("_deg", "max_out_degree") if key == "src" else ("_indeg", "max_in_degree")
    if parts <= 1 or int(stats[most] or 0) <= threshold:
        return _Edges(key, e, None, [], stats)
    hubs = sorted(r["id"] for r in degrees.where(F.col(degree) > threshold).select("id").collect())
    return _parted(e, path, key, hubs, stats)


def _parted(e: DataFrame, path: str, key: str, hubs: list, stats: Row) -> _Edges:
    if not hubs:
        return _Edges(key, e, None, [], stats)
    files = e.sparkSession.read.schema(e.schema).parquet(path)
    return _Edges(key, e.where(~F.col(key).isin(hubs)), files.where(F.col(key).isin(hubs)), hubs, stats)


def _vertex_table(vertices: DataFrame, e: DataFrame | None, min_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per vertex id, hash-partitioned on id (one shuffle).

    With ``e``, every edge endpoint that is no vertex is added with NULL
    properties (GraphX's missing-endpoint fill), and the same aggregation
    counts each vertex's out-degree (``_deg``) and, per column in
    ``min_columns``, the minimum and NULL count over its out-edges -- the edge
    statistics come for free with the vertex table.  A repeated id keeps the
    smallest value (one property) or property struct -- a fixed pick; filled
    ends never win over a real row.
    Partial aggregation collapses a repeated id before the shuffle.
    """
    props = [f for f in vertices.schema.fields if f.name != "id"]
    # one number or flag per vertex is aggregated as it is (hash aggregation);
    # several properties, or texts, must come from one row
    plain = len(props) == 1 and isinstance(props[0].dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
    if plain or not props:
        mine = {p.name: F.col(p.name) for p in props}
        pick = [F.min(p.name).alias(p.name) for p in props]
        read = [F.col(p.name) for p in props]
    else:
        mine = {"_v": F.struct(F.lit(False).alias("_filled"), *[p.name for p in props])}
        pick = [F.min("_v").alias("_v")]
        read = [F.col(f"_v.{p.name}").alias(p.name) for p in props]
    rows = vertices.where(F.col("id").isNotNull()).select("id", *[c.alias(n) for n, c in mine.items()])
    if e is None:
        return rows.groupBy("id").agg(*pick).select("id", *read) if pick else rows.distinct()
    counted = [F.sum("_out").alias("_deg"), F.sum("_in").alias("_indeg")]
    counted += [F.min(f"_min_{c}").alias(f"_min_{c}") for c in min_columns]
    counted += [F.sum(f"_nulls_{c}").alias(f"_nulls_{c}") for c in min_columns]
    zero = F.lit(0).cast("long")
    ends = F.array(
        F.struct(
            F.col("src").alias("id"),
            F.lit(1).cast("long").alias("_out"),
            zero.alias("_in"),
            *[F.col(c).alias(f"_min_{c}") for c in min_columns],
            *[F.col(c).isNull().cast("long").alias(f"_nulls_{c}") for c in min_columns],
        ),
        F.struct(
            F.col("dst").alias("id"),
            zero.alias("_out"),
            F.lit(1).cast("long").alias("_in"),
            *[F.lit(None).cast(e.schema[c].dataType).alias(f"_min_{c}") for c in min_columns],
            *[zero.alias(f"_nulls_{c}") for c in min_columns],
        ),
    )
    # one scan of the edges gives both ends
    both = e.select(F.explode(ends).alias("_end")).select("_end.*")
    out = rows.unionByName(both, allowMissingColumns=True).groupBy("id").agg(*pick, *counted)
    nulls = [F.coalesce(f"_nulls_{c}", zero).alias(f"_nulls_{c}") for c in min_columns]
    degrees = [F.coalesce(c, zero).alias(c) for c in ("_deg", "_indeg")]
    return out.select("id", *read, *degrees, *[f"_min_{c}" for c in min_columns], *nulls)


class _StateStore:
    """Tables of one Pregel run under the session's checkpoint directory: the
    edge sets and the vertex state per superstep (bucketed on ``id`` into
    ``parts`` buckets).

    Tables are registered in the session catalog under unique names (needed
    for the bucket spec) and dropped, files included, as the loop moves on.
    """

    def __init__(self, spark, parts: int, run: str | None = None) -> None:
        if run is not None and not re.fullmatch("[a-z0-9_]+", run):
            raise ValueError("the name of a run has lower-case letters, digits and underscores only")
        self.spark = spark
        self.parts = parts
        self.run = run
        self.saved = False  # a manifest is there
        self.tag = run or uuid.uuid4().hex[:16]
        self.tables: list[str] = []
        self.specs: dict[str, tuple[str, str | None]] = {}  # schema and bucket column of each table
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/pregel-{self.tag}"
        for other in [o for o in _OPEN if run is not None and o.run == run]:
            _OPEN.remove(other)  # it failed; its tables are this one's now
        _OPEN.append(self)

    def name(self, key: str) -> str:
        return f"graphloom_pregel_{self.tag}_{key}"

    def path(self, key: str) -> str:
        return f"{self.base}/{key}"

    def write_table(
        self,
        df: DataFrame,
        key: str,
        *metrics: Column,
        bucket: str | None = None,
        columns: list[str] | None = None,
        keep: Column | None = None,
    ) -> tuple[DataFrame, dict]:
        """Write ``df`` as table ``key`` (bucketed on ``bucket`` into ``parts``
        buckets when given; ``df`` should then already be hash-partitioned on
        it) and return the table read back plus the observed metrics.  The
        metrics see all of ``df``; only ``columns`` (default: all) of the rows
        where ``keep`` holds (default: all) are written."""
        obs = Observation(f"pregel-{self.tag}-{key}") if metrics else None
        out = df.observe(obs, *metrics) if obs is not None else df
        if keep is not None:
            out = out.where(keep)
        if columns is not None:
            out = out.select(*columns)
        writer = out.write.format("parquet").option("path", self.path(key))
        if bucket is not None:
            writer = writer.bucketBy(self.parts, bucket).sortBy(bucket)
        self.tables.append(key)
        self.specs[key] = (out.schema.json(), bucket)
        writer.saveAsTable(self.name(key))
        return self.spark.table(self.name(key)), (obs.get if obs is not None else {})

    def write(
        self, df: DataFrame, superstep: int, *metrics: Column, columns: list[str] | None = None, keep: Column | None = None
    ) -> tuple[DataFrame, dict]:
        """Write one superstep's state, bucketed on id."""
        return self.write_table(df, self.step(superstep), *metrics, bucket="id", columns=columns, keep=keep)

    @staticmethod
    def step(superstep: int) -> str:
        return f"superstep_{superstep:06d}"

    def _fs(self, path: str):
        """(file system, path) as Spark sees them."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _listed(self) -> list[str]:
        fs, base = self._fs(self.base)
        return sorted(s.getPath().getName() for s in fs.listStatus(base)) if fs.exists(base) else []

    def save(self, step: int, manifest: dict, tables: list[str]) -> None:
        """Write the run's manifest: complete under its final name, the one before it
        deleted afterwards."""
        manifest = manifest | {"parts": self.parts, "tables": {key: self.specs[key] for key in tables}}
        name = f"manifest-{step:06d}.json"
        fs, draft = self._fs(f"{self.base}/{name}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._fs(f"{self.base}/{name}")[1]
        fs.delete(final, False)
        fs.rename(draft, final)
        self.saved = True
        for old in self._listed():
            if old.startswith("manifest-") and old != name:
                self._delete(f"{self.base}/{old}")

    def load(self) -> dict | None:
        """The manifest of the run of this name, if any, with its tables registered
        again.  What an unfinished round left is deleted."""
        done = [f for f in self._listed() if re.fullmatch(r"manifest-\d+\.json", f)]
        manifest = json.loads(self.spark.read.text(f"{self.base}/{done[-1]}", wholetext=True).first()[0]) if done else {"tables": {}}
        for left in self._listed():
            if left not in manifest["tables"] and left not in done[-1:]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(left)}") if re.fullmatch("[a-z0-9_]+", left) else None
                self._delete(f"{self.base}/{left}")
        if not done:
            return None
        self.saved, self.parts = True, int(manifest["parts"])
        there = set(self._listed())
        for key, (schema, bucket) in manifest["tables"].items():
            if key not in there:  # edges of a run that has ended
                continue
            columns = self.spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(schema).toDDL()
            dealt = f"CLUSTERED BY (`{bucket}`) SORTED BY (`{bucket}`) INTO {self.parts} BUCKETS" if bucket else ""
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(key)}")
            self.spark.sql(f"CREATE TABLE {self.name(key)} ({columns}) USING parquet {dealt} LOCATION '{self.path(key)}'")
            self.tables.append(key)
            self.specs[key] = (schema, bucket)
        return manifest

    def _delete(self, path: str) -> None:
        try:
            fs, p = self._fs(path)
            fs.delete(p, True)
        except Exception as exc:  # cleanup is best effort, but not silent
            _log.warning("could not delete %s: %s", path, exc)

    def drop(self, key: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(key)}")
        if key in self.tables:
            self.tables.remove(key)
        self._delete(self.path(key))

    def drop_all(self) -> None:
        for key in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(key)}")
        self.tables.clear()
        self._delete(self.base)
        if self in _OPEN:
            _OPEN.remove(self)


@dataclass
class _Level:
    """One table of the log-structured state."""

    table: DataFrame  # id, state, changed, n, since
    key: int  # the superstep that wrote it
    rows: int


def _newest(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``rows`` (with ``id``) plus the newest ``state`` and ``since`` of their
    vertices; rows that are no vertex drop out.  All levels are bucketed alike."""
    state, since = F.col("_s0"), F.col("_t0")
    for k, level in enumerate(levels):
        own = level.select("id", F.col("state").alias(f"_s{k}"), F.col("since").alias(f"_t{k}"))
        rows = rows.join(own, "id", "left" if k else "inner")
        if k:
            state = F.when(F.col(f"_t{k}").isNotNull(), F.col(f"_s{k}")).otherwise(state)
            since = F.coalesce(F.col(f"_t{k}"), since)
    out = rows.select("*", state.alias("state"), since.alias("since"))
    return out.drop(*[f"_{c}{k}" for k in range(len(levels)) for c in "st"])


def _current(levels: list[DataFrame], *carry: str) -> DataFrame:
    """(id, state, since, *carry) of every vertex."""
    if len(levels) == 1:
        return levels[0].select("id", "state", "since", *carry)
    return _newest(levels[0].select("id", *carry), levels)


def _sent(frontier: DataFrame, levels: list[DataFrame], edges: _Edges, program: VertexProgram, only: list | None, once: bool) -> DataFrame:
    """(id, msg): what the active vertices send along their edges on one side.
    ``once``: leave out edges whose other end is active too (it sends them)."""
    key, other = edges.key, edges.other
    active = frontier.select(F.col("id").alias(key), F.col("state").alias(f"{key}_state"))
    cold = edges.cold if only is None else edges.cold.where(F.col(key).isin(only))
    # co-partitioned with the edges: the join runs where the data is
    sent = cold.join(active, key)
    if edges.hot is not None:
        # at most one row per hub
        hub_frontier = active.where(F.col(key).isin(edges.hubs))
        hot = edges.hot if only is None else edges.hot.where(F.col(key).isin(only))
        sent = sent.unionByName(hot.join(F.broadcast(hub_frontier), key))
    if once:
        sent = sent.join(frontier.select(F.col("id").alias(other)), other, "left_anti")
    if program.send_triplet is None and program.send_all is None:
        message = program.send(F.col(f"{key}_state"))
        return sent.select(F.col(other).alias("id"), message.alias("msg")).where(F.col("msg").isNotNull())
    far = _current(levels).select(F.col("id").alias(other), F.col("state").alias(f"{other}_state"))
    both = sent.join(far, other)
    if program.send_all is not None:
        return both.select(F.explode(program.send_all(F.col("src_state"), F.col("dst_state"))).alias("_m")).select("_m.id", "_m.msg")
    message = program.send_triplet(F.col("src_state"), F.col("dst_state"))
    return both.select(F.col(other).alias("id"), message.alias("msg")).where(F.col("msg").isNotNull())


def _superstep(
    frontier: DataFrame,
    levels: list[DataFrame],
    sides: list[_Edges],
    program: VertexProgram,
    round_: int,
    carry: list[str],
    only: list | None = None,
    take_over: int | None = None,
) -> DataFrame:
    """One superstep over the state in ``levels`` with the active ``frontier`` (id,
    state) -> (id, state, changed, n, since, *carry, _kept); ``n`` = messages
    received, ``changed`` = active in the next round.

    ``take_over`` = None gives every vertex.  A number gives the receivers and the
    rows of so many newest levels, where ``_kept`` marks the latter.  ``only``: the
    frontier's ids where they are few enough to be pushed into the edge scan.
    """
    sent = None
    for i, edges in enumerate(sides):
        part = _sent(frontier, levels, edges, program, only, once=i > 0 and program.send_all is not None)
        sent = part if sent is None else sent.unionByName(part)
    received = sent.groupBy("id").agg(program.merge(F.col("msg")).alias("msg"), F.count(F.lit(1)).alias("n"))
    kept = F.lit(False)
    if take_over is None:
        joined = _current(levels, *carry).join(received, "id", "left")
        kept = F.lit(True)
    elif take_over == 0:
        joined = _newest(received, levels)
    else:
        old = levels[-take_over].select("id")
        for level in levels[len(levels) - take_over + 1 :]:
            old = old.join(level.select("id"), "id", "full")
        joined = _newest(old.withColumn("_old", F.lit(True)).join(received, "id", "full"), levels)
        kept = F.col("_old").isNotNull()
    got = F.col("msg").isNotNull()
    new_state = F.when(got, program.update(F.col("state"), F.col("msg"))).otherwise(F.col("state"))
    different = got & ~new_state.eqNullSafe(F.col("state"))
    return joined.select(
        "id",
        new_state.alias("state"),
        (got if program.active_on == "received" else different).alias("changed"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.when(different, F.lit(round_)).otherwise(F.col("since")).alias("since"),
        *carry,
        kept.alias("_kept"),
    )


class PreparedGraph:
    """A graph whose edges and vertex table are written once, for several runs.

    Holds the edges bucketed on ``src`` (and, with ``directions`` "in" or
    "either", on ``dst``), the vertex table with its degrees, the hubs and the
    edge statistics.  Give it to :func:`pregel` or to an algorithm in place of a
    graph; :meth:`release` deletes what it wrote.
    """

    def __init__(self, graph: PropertyGraph, *, directions: tuple[str, ...] = ("out",), edge_min_columns: tuple[str, ...] = (), partitions: int | None = None):
        spark = graph.vertices.sparkSession
        self.store = _StateStore(spark, partitions or shuffle_partitions(spark))
        self.edge_min_columns = tuple(edge_min_columns)
        try:
            with _dealt_like(spark, self.store.parts):
                self.edges, _ = _write_edges(self.store, graph.edges, "src")
                table = _vertex_table(graph.vertices, self.edges, self.edge_min_columns)
                self.vertices, seen = self.store.write_table(
                    table, "vertices", F.count(F.lit(1)).alias("vertices"), *_stat_columns(self.edge_min_columns), bucket="id"
                )
                self.stats = Row(**{k: v for k, v in seen.items() if k != "vertices"})
                self.vertex_count = int(seen["vertices"])
                self._sides: dict[str, _Edges] = {}
                for direction in directions:
                    self.sides(direction)
        except BaseException:
            self.release()
            raise

    def sides(self, direction: str) -> list[_Edges]:
        """The adjacencies of a direction; one that is missing is written now."""
        return [self._side(key) for key in _KEYS[direction]]

    def _side(self, key: str) -> _Edges:
        if key not in self._sides:
            e = self.edges if key == "src" else _write_edges(self.store, self.edges, "dst")[0]
            path = self.store.path("edges" if key == "src" else "edges_in")
            self._sides[key] = _split_hubs(e, path, key, self.stats, self.vertices, self.store.parts)
        return self._sides[key]

    def release(self) -> None:
        self.store.drop_all()


_KEYS = {"out": ["src"], "in": ["dst"], "either": ["src", "dst"]}


def _write_edges(store: "_StateStore", edges: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(edges bucketed on one end, their number).  They are computed and written once, whatever
    produced them; a hot end's rows are split over several writing tasks."""
    name = "edges" if key == "src" else "edges_in"
    table, seen = store.write_table(edges.where(not_null("src", "dst")).hint("rebalance", key), name, F.count(F.lit(1)).alias("edges"), bucket=key)
    return table, int(seen["edges"])


@contextmanager
def _dealt_like(spark, parts: int):
    """Within it, shuffles deal rows like the buckets; the session's own number of
    shuffle partitions holds again afterwards."""
    own = str(shuffle_partitions(spark))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)


def pregel(
    graph: PropertyGraph | PreparedGraph,
    program: VertexProgram | None,
    *,
    state: Column | None,
    active: Column | None = None,
    max_iterations: int | Callable[[int], int] | None = None,
    direction: str = "out",
    fill_missing: bool = True,
    prepare_vertices: Callable[[DataFrame, PropertyGraph], DataFrame] | None = None,
    edge_min_columns: tuple[str, ...] = (),
    validate: Callable[[Row, int], None] | None = None,
    fuse: int = 1,
    partitions: int | None = None,
    keep_edges: bool = False,
    by_size: Callable[[int], tuple[VertexProgram, Column]] | None = None,
    after_round: Callable[[Progress], None] | None = None,
    resume: str | None = None,
) -> PregelResult:
    """Run ``program`` on ``graph`` until no vertex is active (or the cap).

    ``state`` is the start state, a column over the vertex table (superstep 0).
    ``active`` selects the vertices that send in the first round (default:
    state is not NULL).  ``max_iterations`` caps the message rounds (None =
    until convergence; a function gets the vertex count).
    ``direction``: an active vertex sends along its out-edges, its in-edges or
    either (an edge with two active ends is then used from both, but by
    ``send_all`` once).
    ``validate(edge_stats, vertex_count)`` may raise before the first round.

    With ``fill_missing`` every edge endpoint missing from the vertex table
    becomes a vertex with NULL properties (otherwise messages to it are
    dropped); ``prepare_vertices(vertex_table, graph)`` may then add columns
    that ``state`` reads (it should keep the rows partitioned on id: joins on
    id do); its ``graph`` has the already written edges.  A repeated
    vertex id is kept once.  Edges with a NULL endpoint carry nothing and are
    left out.

    ``fuse`` supersteps run in one job (one shuffle each, one state write for
    all of them): the intermediate state stays inside the job, so fewer writes
    and fewer jobs, while results and the per-superstep trace are unchanged.
    ``partitions`` is the number of buckets (default: the session's shuffle
    partitions); size it so that a bucket's states and edges fit a task.  A
    :class:`PreparedGraph` brings its own and fills missing endpoints.
    ``keep_edges`` leaves the written edges to the result until it is released.
    ``by_size(edges)``, if given, picks the program and the start state by the
    number of edges.  ``after_round(progress)`` may raise to end the run.

    ``resume`` names the run (lower-case letters, digits, underscores; ids must be
    numbers or texts).  After every round a manifest in the checkpoint folder says
    which tables hold it, and a call with the same name, in this session or
    after the driver was lost, goes on from the last complete round with the same
    results and trace; the graph is not read again.  Give the same program and
    options.  The run's tables stay until its result is released, or until an
    error of the data (a ``ValueError``) ends it.  Two calls must not share a name
    at the same time.
    """
    if fuse < 1:
        raise ValueError("fuse must be at least 1")
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    spark = graph.vertices.sparkSession
    prepared = isinstance(graph, PreparedGraph)
    if prepared and not set(edge_min_columns) <= set(graph.edge_min_columns):
        raise ValueError(f"the graph was prepared without statistics of {edge_min_columns}")
    if prepared and resume is not None:
        raise ValueError("a run over a prepared graph cannot be resumed: its edges go with the driver")
    parts = graph.store.parts if prepared else partitions or shuffle_partitions(spark)
    store = _StateStore(spark, parts, resume)
    try:
        manifest = store.load() if resume is not None else None
        with _dealt_like(spark, store.parts):
            return _run(
                graph, program, store, state, active, max_iterations, direction, fill_missing or prepared, prepare_vertices,
                edge_min_columns, validate, fuse, keep_edges, by_size, after_round, manifest,
            )
    except BaseException as exc:
        if not store.saved or isinstance(exc, ValueError):
            store.drop_all()
        raise


@dataclass
class _Start:
    """What the rounds of a run go on from."""

    edges: DataFrame
    edge_count: int
    stats: Row
    vertex_count: int
    sides: list[_Edges]
    levels: list[_Level]
    n_active: int
    rounds: int
    trace: list[tuple]


def _begin(graph, store, state, active, direction, fill_missing, prepare_vertices, edge_min_columns, by_size) -> tuple[_Start, Callable]:
    """(state of superstep 0, what gives the edges by the end they are bucketed on).
    The sides are added after the caller has looked at the statistics."""
    prepared = graph if isinstance(graph, PreparedGraph) else None
    e, edge_count = (prepared.edges, int(prepared.stats["edges"] or 0)) if prepared else _write_edges(store, graph.edges, "src")
    if by_size is not None:
        state = by_size(edge_count)[1]
    stats_cols: list[str] = []
    stat_metrics: list[Column] = []
    degree_cols = ["_deg", "_indeg"] if fill_missing and not prepared else []
    degrees = None
    if prepared:
        vertices, stats = prepared.vertices, prepared.stats
    elif fill_missing:
        # edge statistics ride along with the vertex table (no job of their own)
        vertices = _vertex_table(graph.vertices, e, edge_min_columns)
        stats_cols = [*degree_cols, *[f"_min_{c}" for c in edge_min_columns], *[f"_nulls_{c}" for c in edge_min_columns]]
        stat_metrics = _stat_columns(edge_min_columns)
    else:
        stats, degrees = _edge_stats(e, edge_min_columns)
        vertices = _vertex_table(graph.vertices, None)
    if prepare_vertices is not None:
        vertices = prepare_vertices(vertices, PropertyGraph(graph.vertices, e))
    start_active = active if active is not None else state.isNotNull()
    start = vertices.select(
        F.col("id"),
        state.alias("state"),
        F.coalesce(start_active, F.lit(False)).alias("changed"),
        F.lit(0).cast("long").alias("n"),
        F.lit(0).alias("since"),
        *stats_cols,
    )
    base, first = store.write(
        start,
        0,
        F.count(F.lit(1)).alias("vertices"),
        F.count_if("changed").alias("active"),
        *stat_metrics,
        columns=["id", "state", "changed", "n", "since", *degree_cols],
    )
    if stat_metrics:
        stats = Row(**{k: v for k, v in first.items() if k not in ("vertices", "active")})
        degrees = base.select("id", *degree_cols)
    vertex_count = int(first["vertices"])

    def sides() -> list[_Edges]:
        if prepared:
            return prepared.sides(direction)
        out = []
        for key in _KEYS[direction]:
            table = e if key == "src" else _write_edges(store, e, "dst")[0]
            out.append(_split_hubs(table, store.path("edges" if key == "src" else "edges_in"), key, stats, degrees, store.parts))
        return out

    return _Start(e, edge_count, stats, vertex_count, [], [_Level(base, 0, vertex_count)], int(first["active"]), 0, []), sides


def _manifest(run: _Start) -> dict:
    """The run as JSON, but for its tables."""
    plain = {k: v if v is None or isinstance(v, (int, float, str)) else str(v) for k, v in run.stats.asDict().items()}
    return {
        "edge_count": run.edge_count,
        "stats": plain,
        "vertex_count": run.vertex_count,
        "hubs": {side.key: side.hubs for side in run.sides},
        "levels": [[level.key, level.rows] for level in run.levels],
        "n_active": run.n_active,
        "rounds": run.rounds,
        "trace": run.trace,
    }


def _resumed(store: _StateStore, manifest: dict) -> _Start:
    def table(key: str) -> DataFrame | None:
        return store.spark.table(store.name(key)) if key in store.tables else None

    stats = Row(**manifest["stats"])
    edges = table("edges")
    sides = []
    for key, hubs in manifest["hubs"].items():
        name = "edges" if key == "src" else "edges_in"
        if table(name) is not None:
            sides.append(_parted(table(name), store.path(name), key, hubs, stats))
    levels = [_Level(table(store.step(key)), key, rows) for key, rows in manifest["levels"]]
    trace = [tuple(row) for row in manifest["trace"]]
    return _Start(edges, manifest["edge_count"], stats, manifest["vertex_count"], sides, levels, manifest["n_active"], manifest["rounds"], trace)


def _run(
    graph, program, store, state, active, max_iterations, direction, fill_missing, prepare_vertices, edge_min_columns, validate, fuse, keep_edges, by_size,
    after_round, manifest,
) -> PregelResult:
    spark = store.spark
    sides_of = None
    if manifest is None:
        run, sides_of = _begin(graph, store, state, active, direction, fill_missing, prepare_vertices, edge_min_columns, by_size)
    else:
        run = _resumed(store, manifest)
    if by_size is not None:
        program = by_size(run.edge_count)[0]
    vertex_count, stats, e = run.vertex_count, run.stats, run.edges
    if callable(max_iterations):
        max_iterations = max_iterations(vertex_count)
    if validate is not None:
        validate(stats, vertex_count)
    if sides_of is not None:
        run.sides = sides_of()
        if store.run is not None:
            store.save(0, _manifest(run), list(store.tables))
    sides, levels, trace, rounds, n_active = run.sides, run.levels, run.trace, run.rounds, run.n_active
    converged = n_active == 0
    while not converged:
        if max_iterations is not None and rounds >= max_iterations:
            break
        if not sides:
            raise RuntimeError("the run has ended and its edges are gone: it cannot take more rounds")
        started = time.perf_counter()
        steps = fuse if max_iterations is None else max(1, min(fuse, max_iterations - rounds))
        tables = [level.table for level in levels]
        frontier = tables[-1].where("changed").select("id", "state")
        only = None
        if n_active <= PUSH_IDS and int(stats["edges"] or 0) >= PUSH_EDGES:
            only = [r["id"] for r in frontier.select("id").collect()]  # at most PUSH_IDS
        # the rows written last tell how many this round is about to write
        taken, expected = 0, n_active
        for level in reversed(levels[1:]):
            if level.rows > expected and len(levels) - taken <= MAX_DELTAS:
                break
            taken, expected = taken + 1, expected + level.rows
        full = steps > 1 or vertex_count <= BASE_ROWS or expected * BASE_SHARE >= vertex_count
        # `steps` supersteps in one job; earlier steps' counters ride along as
        # columns so each superstep still gets its own trace row
        carry: list[str] = []
        cur = _superstep(frontier, tables, sides, program, rounds + 1, carry, only, None if full else taken)
        for k in range(2, steps + 1):
            cur = cur.withColumn(f"_changed_{k - 1}", F.col("changed")).withColumn(f"_n_{k - 1}", F.col("n"))
            carry += [f"_changed_{k - 1}", f"_n_{k - 1}"]
            cur = _superstep(cur.where("changed").select("id", "state"), [cur], sides, program, rounds + k, carry)
        metrics = []
        for k in range(1, steps + 1):
            changed_col, n_col = ("changed", "n") if k == steps else (f"_changed_{k}", f"_n_{k}")
            metrics += [
                F.count_if(changed_col).alias(f"changed_{k}"),
                F.sum(n_col).alias(f"messages_{k}"),
                F.count_if(F.col(n_col) > 0).alias(f"receivers_{k}"),
            ]
        metrics.append(F.count_if(F.col("_kept") | F.col("changed")).alias("rows"))
        key = rounds + steps
        keep = None if full else F.col("_kept") | F.col("changed")
        table, row = store.write(cur, key, *metrics, columns=["id", "state", "changed", "n", "since"], keep=keep)
        gone = levels if full else levels[len(levels) - taken :]
        levels = [*([] if full else levels[: len(levels) - taken]), _Level(table, key, int(row["rows"] or 0))]
        elapsed = time.perf_counter() - started
        for k in range(1, steps + 1):
            changed = int(row[f"changed_{k}"] or 0)
            rounds += 1
            trace.append(
                (
                    rounds,
                    n_active,
                    int(row[f"messages_{k}"] or 0),
                    int(row[f"receivers_{k}"] or 0),
                    changed,
                    round(elapsed / steps, 3),
                )
            )
            n_active = changed
            if changed == 0:
                converged = True
                break
        if store.run is not None:
            run.levels, run.rounds, run.n_active = levels, rounds, n_active
            held = {store.step(level.key) for level in levels}
            store.save(key, _manifest(run), [t for t in store.tables if t.startswith("edges") or t in held])
        for level in gone:
            store.drop(store.step(level.key))
        if after_round is not None and not converged:
            after_round(Progress(rounds, vertex_count, stats, _current([level.table for level in levels]), e, store))

    # the state is all that stays
    if store.run is not None and not keep_edges:
        run.sides = []
        store.save(rounds, _manifest(run), [store.step(level.key) for level in levels])
    for key in [k for k in store.tables if k.startswith("edges") and not keep_edges]:
        store.drop(key)
    trace_df = spark.createDataFrame(trace, _TRACE_SCHEMA)
    settled = _current([level.table for level in levels])
    return PregelResult(
        vertices=settled.select("id", "state"),
        settled=settled,
        rounds=rounds,
        converged=converged,
        trace=trace_df,
        edge_stats=stats,
        edges=e if keep_edges else None,
        _store=store,
    )
