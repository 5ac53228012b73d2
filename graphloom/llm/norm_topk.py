"""Exact maximum inner product search over length-bucketed integer vectors.

Candidates are range-partitioned by vector length, so a partition holds
vectors of similar length, and each partition is cut into buckets by falling
length.  A first pass over the longest vectors gives every query a lower bound
of its k-th score.  In every bucket that bound becomes a local cosine
threshold: above 1 the bucket is skipped, a high threshold prunes by the
query's strongest coordinate, a low one by length alone; the surviving pairs
are verified with exact integer products.

Queries are dealt in blocks: a task holds one partition's candidates beside one
block of queries at a time, so neither many queries nor many visits to one
partition meet in one task.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.scratch import materialize

BUCKET = 2048  # vectors of a bucket
PART_ROWS = 50_000  # candidates of a partition
QUERY_BLOCK = 8192  # queries of a block, on average; each block gets its own copy of a partition
QUERY_BATCH = 512  # queries handled at once
MAX_TASKS = 100_000  # tasks of a search; more (partition, block) groups share them, one after the other
COORDINATE_COSINE = 0.6  # local threshold from which a coordinate prunes better than length
_EXACT = float(1 << 53)


def quantized(vec: Column, scale: int = 256) -> Column:
    """floor(scale * component) as array<long>; NULL unless every component is finite."""
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    bad = F.exists(
        vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) > F.lit(1.7976931348623157e308))
    )
    return F.when(vec.isNotNull() & ~F.coalesce(bad, F.lit(False)), whole)


def _dots(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Integer products; by BLAS when doubles hold every partial sum exactly."""
    if exact:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    big = q.astype(object) @ v.astype(object).T
    low, high = -(1 << 63), (1 << 63) - 1
    return np.clip(big, low, high).astype(np.int64)  # scores beyond a long saturate


def _below(x):
    """A double not above the integer score that ``x`` was rounded from."""
    return x - np.abs(x) * 2.0**-52


class _Best:
    """Running k best (score, smaller id first) of a batch of queries."""

    def __init__(self, ids: np.ndarray, bound: np.ndarray, k: int):
        self.own, self.k, self.bound = ids, k, _below(bound)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)

    def offer(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores >= self.bound[i]) & (ids != self.own[i])
        if not keep.any():
            return
        ids, scores = ids[keep], scores[keep]
        if len(scores) > self.k:  # the k-th score of these alone, with all its ties
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        old = self.found[i]
        s, v = np.concatenate((old[0], scores)), np.concatenate((old[1], ids))
        order = np.lexsort((v, -s))[: self.k]
        self.found[i] = (s[order], v[order])
        if len(order) == self.k:
            self.bound[i] = max(self.bound[i], int(s[order[-1]]))


class _Bucket:
    """Vectors of similar length with sorted coordinates of their directions."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, lengths: np.ndarray):
        self.ids, self.vecs, self.lengths = ids, vecs, lengths
        self.longest = float(lengths[0]) if len(lengths) else 0.0
        safe = np.where(lengths > 0, lengths, 1.0)
        self.unit = vecs / safe[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = order, self.unit[order, f]
        return self.sorted[f]

    def search(self, best: _Best, q: np.ndarray, q_len: np.ndarray, exact: bool) -> None:
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(q_len * self.longest > 0, best.bound / (q_len * self.longest), -1.0)
            local = np.where((q_len * self.longest <= 0) & (best.bound > 0), 2.0, local)
        by_length = np.flatnonzero(local < COORDINATE_COSINE)
        if len(by_length):
            # length pruning: only vectors with |v| >= bound / |q| can reach the bound
            need = np.where(q_len[by_length] > 0, best.bound[by_length] / np.where(q_len[by_length] > 0, q_len[by_length], 1.0), 0.0)
            reach = np.searchsorted(-self.lengths, -(need * (1 - 1e-9) - 1e-9), side="right")
            top = int(reach.max(initial=0))
            if top:
                scores = _dots(q[by_length], self.vecs[:top], exact)
                for row, i in enumerate(by_length.tolist()):
                    n = int(reach[row])
                    best.offer(i, self.ids[:n], scores[row, :n])
        for i in np.flatnonzero((local >= COORDINATE_COSINE) & (local <= 1 + 1e-9)).tolist():
            # coordinate pruning: cos >= t needs v_f within q_f t -+ sqrt((1 - q_f^2)(1 - t^2)),
            # and up to the pole on the side where q itself is that close to it
            u = q[i] / q_len[i]
            f = int(np.argmax(np.abs(u)))
            t = min(1.0, local[i])
            around = np.sqrt(max(0.0, 1 - u[f] ** 2) * max(0.0, 1 - t * t)) + 1e-9
            order, values = self.coordinate(f)
            low = -1.1 if -u[f] >= t else u[f] * t - around
            high = 1.1 if u[f] >= t else u[f] * t + around
            pick = order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            if len(pick):
                best.offer(i, self.ids[pick], _dots(q[i : i + 1], self.vecs[pick], exact)[0])


def _search_partition(dim_of: str, k: int) -> object:
    """Task over whole parts, one after the other, each with its candidates before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[int, list[np.ndarray]] = {}
        vecs: dict[int, list[np.ndarray]] = {}
        buckets: dict[int, list[_Bucket]] | None = None
        biggest: dict[int, int] = {}
        current = None

        def grouped(batch: pa.RecordBatch):
            dims = batch.column(dim_of).to_numpy()
            flat = batch.column("v")
            starts = flat.offsets.to_numpy()
            values = flat.values.to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                rows = starts[at][:, None] + np.arange(d)
                yield d, at, values[rows] if d else np.zeros((len(at), 0), np.int64)

        def build() -> dict[int, list[_Bucket]]:
            out: dict[int, list[_Bucket]] = {}
            for d in ids:
                i, v = np.concatenate(ids[d]), np.concatenate(vecs[d])
                biggest[d] = int(np.abs(v.astype(np.float64)).max(initial=0))
                length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
                order = np.lexsort((i, -length))
                i, v, length = i[order], v[order], length[order]
                out[d] = [_Bucket(i[a : a + BUCKET], v[a : a + BUCKET], length[a : a + BUCKET]) for a in range(0, len(i), BUCKET)]
            ids.clear(), vecs.clear()
            return out

        def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
            for batch in batches:
                of = batch.column("part").to_numpy()
                cuts = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, np.arange(0, batch.num_rows, QUERY_BATCH), [batch.num_rows])))
                for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    yield int(of[a]), batch.slice(a, z - a)

        for number, part in pieces():
            if number != current:  # another part: its candidates come first
                current, buckets = number, None
                ids.clear(), vecs.clear(), biggest.clear()
            is_query = part.column("query").to_numpy(zero_copy_only=False)
            cand, queries = part.filter(pa.array(~is_query)), part.filter(pa.array(is_query))
            if cand.num_rows:
                for d, at, v in grouped(cand):
                    ids.setdefault(d, []).append(cand.column("vec_id").to_numpy()[at])
                    vecs.setdefault(d, []).append(v)
            if not queries.num_rows:
                continue
            if buckets is None:
                buckets = build()
            for d, at, q in grouped(queries):
                own = queries.column("vec_id").to_numpy()[at]
                best = _Best(own, queries.column("bound").to_numpy()[at].astype(np.float64), k)
                q_len = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                exact = float(np.abs(q.astype(np.float64)).max(initial=0)) * biggest.get(d, 0) * max(d, 1) < _EXACT
                for bucket in buckets.get(d, []):
                    bucket.search(best, q, q_len, exact)
                rows = [(int(o), int(v), int(s)) for o, (ss, vv) in zip(own, best.found) for s, v in zip(ss, vv)]
                if rows:
                    qi, vi, sc = zip(*rows)
                    yield pa.RecordBatch.from_pydict(
                        {"query_id": pa.array(qi, pa.int64()), "vec_id": pa.array(vi, pa.int64()), "score": pa.array(sc, pa.int64())}
                    )

    return run


_FOUND = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())]
)
_NO_BOUND = -9.3e18


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query; a query has at most k rows per partition."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, part_rows: int = PART_ROWS) -> DataFrame:
    """Each query's ``k`` highest integer inner products with all other vectors.

    ``vectors`` has ``vec_id`` (long) and ``v`` (array<long>); rows with a null
    id or vector take no part, and a vector meets only vectors of its own
    dimension.  Ties go to the smaller id.  Rows with a query's own id are not
    its candidates; repeated ids are candidates each and one query.  Returns ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score``; an empty frame gives no rows.
    Scores beyond a long saturate.
    """
    spark = vectors.sparkSession
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "v",
        F.size("v").alias("dim"),
        F.sqrt(length).alias("len"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asked"), 1)).alias("asked")).first()
    n, blocks = size["n"], max(1, -(-size["asked"] // QUERY_BLOCK))
    parts = max(1, -(-n // part_rows), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // BUCKET))
    # longest vectors first; the id splits a run of equal lengths
    dealt = rows.repartitionByRange(parts, F.col("len").desc(), F.col("vec_id")).withColumn(
        "part", F.spark_partition_id()
    )
    base = materialize(dealt, "vectors")
    # a repeated query id is one query, with the smallest of its vectors
    queries = (
        base.where("asked").groupBy("vec_id").agg(F.min(F.struct("v", "dim", "len")).alias("q")).select("vec_id", "q.*")
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)))
    )

    def search(cand: DataFrame, asked: DataFrame) -> DataFrame:
        """``cand`` has the candidates once for every block of ``asked`` that visits their part."""
        group = (F.col("part") * F.lit(blocks) + F.col("block")).alias("part")
        both = cand.select(group, "vec_id", "v", "dim", F.lit(False).alias("query"), F.lit(0.0).alias("bound")).unionByName(
            asked.select(group, "vec_id", "v", "dim", F.lit(True).alias("query"), "bound")
        )
        dealt = both.repartition(min(parts * blocks, max(parts, MAX_TASKS)), "part").sortWithinPartitions("part", "query")
        return map_arrow(dealt.select("part", "vec_id", "v", "dim", "query", "bound"), _search_partition("dim", k), _FOUND)

    # pass 1: the partition with the longest vectors gives every query a bound
    copies = base.where("part = 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    first = search(copies, queries.withColumn("part", F.lit(0)).withColumn("bound", F.lit(_NO_BOUND)))
    first = materialize(first, "topk-first")
    bounds = (
        _ranked(first, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    ).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), F.col("kth").cast("double").alias("bound"))
    bounded = queries.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(_NO_BOUND)))
    # pass 2: a query visits only partitions whose longest vector can reach its bound.
    # One row of at most ``parts`` lengths, 16 bytes for every ``part_rows`` vectors.
    longest = (
        base.where("part > 0").groupBy("part").agg(F.max("len").alias("longest"))
        .agg(F.collect_list(F.struct("part", "longest")).alias("ends")).withColumn("one", F.lit(1))
    )
    reach = F.filter(
        "ends", lambda p: F.col("bound") <= F.col("len") * p["longest"] * F.lit(1 + 1e-9) + F.lit(1e-9)
    )
    visits = (
        bounded.withColumn("one", F.lit(1)).join(F.broadcast(longest), "one")
        .select("vec_id", "v", "dim", "bound", "block", F.explode(F.transform(reach, lambda p: p["part"])).alias("part"))
    )
    wanted = visits.select("part", "block").distinct()
    rest = search(base.where("part > 0").join(wanted, "part"), visits)
    return _ranked(first.unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
