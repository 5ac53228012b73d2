"""Connected components: contraction inside partitions, then star steps.

Every partition of the edges is first replaced by its spanning stars (a
union-find over at most about ``EDGES_PER_PART`` edges).  Where that leaves
more than one partition, large-star and small-star steps alternate: each is a
partial minimum per node and a join back to the edges, whose minimum side is
unique per node, so a hub's edges can be split over tasks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.scratch import materialize

EDGES_PER_PART = 500_000
_STARS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node but the smallest ones."""
    nodes, index = np.unique(np.concatenate((u, v)), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(index[: len(u)].tolist(), index[len(u) :].tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([find(i) for i in range(len(nodes))], np.int64)
    child = roots != np.arange(len(nodes))
    return nodes[child], nodes[roots[child]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        u, v = np.concatenate((u, b.column("u").to_numpy())), np.concatenate((v, b.column("v").to_numpy()))
        if len(u) > 2 * EDGES_PER_PART:  # a larger partition is contracted as it comes
            u, v = stars(u, v)
    u, v = stars(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _toward_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(smallest, "u").withColumn("m", F.least("u", "m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node of an edge; the root is the smallest
    node of the component.  Null ends and self-loops are ignored."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = materialize(e, "edges")
    parts = max(1, -(-e.count() // EDGES_PER_PART))
    e = materialize(map_arrow(e.coalesce(parts), _contract, _STARS), "stars")
    state = _state(e) if parts > 1 else (0, None)  # one partition's stars are the components
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _toward_minimum(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        e = materialize(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        after = _state(e)
        if after == state:
            break
        state = after
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
