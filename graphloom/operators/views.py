"""Graph views: description, triplets, endpoint filling, vertex dedupe."""
from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.graph import PropertyGraph
from graphloom.operators.joins import not_null


def describe(graph: PropertyGraph) -> DataFrame:
    """One row per column of each side: (side, position, column, type).

    Built from the two schemas only; no job runs on the data.
    """
    rows = [
        (side, pos, field.name, field.dataType.simpleString())
        for side, df in (("vertices", graph.vertices), ("edges", graph.edges))
        for pos, field in enumerate(df.schema.fields)
    ]
    schema = "side string, position int, column string, type string"
    return graph.vertices.sparkSession.createDataFrame(rows, schema)


def _prefixed(vertices: DataFrame, key: str, prefix: str) -> DataFrame:
    return vertices.select(
        F.col("id").alias(key),
        *[F.col(c).alias(f"{prefix}{c}") for c in vertices.columns if c != "id"],
    )


def triplets(graph: PropertyGraph) -> DataFrame:
    """Edge + source vertex + destination vertex.

    Columns: src, dst, edge properties, ``src_<p>`` and ``dst_<p>`` for each
    vertex property.  A vertex table small enough is broadcast by Catalyst;
    a larger one takes merge joins whose hot vertices adaptive execution
    splits.  Either way the edges are evaluated once.  Edges whose endpoint is
    not a vertex drop out (inner join), as in a graph view.
    """
    e = graph.edges.where(not_null("src", "dst"))
    return e.join(_prefixed(graph.vertices, "src", "src_"), "src").join(_prefixed(graph.vertices, "dst", "dst_"), "dst")


def endpoint_ids(graph: PropertyGraph) -> DataFrame:
    """Distinct non-null ids named by an edge (partial aggregation first)."""
    e = graph.edges
    return (
        e.select(F.col("src").alias("id"))
        .unionByName(e.select(F.col("dst").alias("id")))
        .where(F.col("id").isNotNull())
        .distinct()
    )


def fill_missing(graph: PropertyGraph, defaults: dict[str, Any]) -> PropertyGraph:
    """Add a vertex for each edge endpoint missing from the vertex table.

    New vertices take ``defaults[prop]`` (NULL where not given) and keep the
    vertex schema.
    """
    missing = endpoint_ids(graph).join(graph.vertices.select("id"), "id", "left_anti")
    schema = graph.vertices.schema
    cols = [F.col("id")]
    for field in schema.fields:
        if field.name == "id":
            continue
        value = defaults.get(field.name)
        cols.append(F.lit(value).cast(field.dataType).alias(field.name))
    added = missing.select(*cols)
    return PropertyGraph(graph.vertices.unionByName(added), graph.edges)


def dedupe_vertices(graph: PropertyGraph) -> PropertyGraph:
    """Keep one row per vertex id: the smallest property struct (a fixed pick).

    Partial aggregation collapses a repeated id before the shuffle, so a hot
    id costs one row per map task.
    """
    props = graph.vertex_properties
    if not props:
        return PropertyGraph(graph.vertices.select("id").distinct(), graph.edges)
    v = graph.vertices.groupBy("id").agg(F.min(F.struct(*props)).alias("_p"))
    return PropertyGraph(v.select("id", *[F.col(f"_p.{p}").alias(p) for p in props]), graph.edges)


def valid_edges(graph: PropertyGraph) -> PropertyGraph:
    """Drop edges with a NULL endpoint (they can carry no message)."""
    return PropertyGraph(graph.vertices, graph.edges.where(not_null("src", "dst")))


def preview(graph: PropertyGraph, side: str, n: int) -> DataFrame:
    """A repeatable preview: first ``n`` rows in key order (top-k, not a full sort)."""
    if side == "vertices":
        return graph.vertices.orderBy("id").limit(n)
    if side == "edges":
        return graph.edges.orderBy("src", "dst", *graph.edge_properties).limit(n)
    raise ValueError("side must be 'vertices' or 'edges'")

