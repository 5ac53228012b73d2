"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (through :mod:`graphloom.sources.tables`)
whole; the iterative ones run their loop when called and return the
persisted result with lazy projections on top.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.pregel import PreparedGraph
from graphloom.operators.views import dedupe_vertices, preview
from graphloom.plans.algorithms import global_max, max_reach, sssp, sssp_paths, strength, walk_counts
from graphloom.plans.report import labelled_costs, path_labels
from graphloom.sources import tables as t

HOP_LIMIT = 3  # rounds allowed in the capped search
PREVIEW_ROWS = 20


def _path_text(col: str = "path") -> F.Column:
    return F.array_join(F.col(col), ">")


def q_trade_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return t.trade(spark, sf).vertices


def q_trade_edges(spark: SparkSession, sf: str) -> DataFrame:
    return t.trade(spark, sf).edges


def q_handoff_edges(spark: SparkSession, sf: str) -> DataFrame:
    return t.handoff(spark, sf).edges


def q_turns_edges(spark: SparkSession, sf: str) -> DataFrame:
    return t.turns(spark, sf).edges


def q_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return t.trade(spark, sf).triplets()


def q_vertex_fill(spark: SparkSession, sf: str) -> DataFrame:
    return t.trade_holes(spark, sf).fill_missing({"value": t.FILL_VALUE}).vertices


def q_max_reach_trade_top3(spark: SparkSession, sf: str) -> DataFrame:
    return max_reach(t.trade_top3(spark, sf)).vertices


def q_max_reach_turns(spark: SparkSession, sf: str) -> DataFrame:
    return max_reach(t.turns(spark, sf)).vertices


def q_global_max(spark: SparkSession, sf: str) -> DataFrame:
    return global_max(t.trade(spark, sf))


def q_sssp_trade(spark: SparkSession, sf: str) -> DataFrame:
    g = t.trade(spark, sf)
    return sssp(g, t.smallest_source).vertices


def q_sssp_trade_top3(spark: SparkSession, sf: str) -> DataFrame:
    g = t.trade_top3(spark, sf)
    return sssp(g, t.smallest_source).vertices


def q_sssp_handoff(spark: SparkSession, sf: str) -> DataFrame:
    return sssp(t.handoff(spark, sf), [t.HANDOFF_SOURCE]).vertices


def q_sssp_turns(spark: SparkSession, sf: str) -> DataFrame:
    return sssp(t.turns(spark, sf), t.turn_starts()).vertices


def q_sssp_paths_handoff(spark: SparkSession, sf: str) -> DataFrame:
    v = sssp_paths(t.handoff(spark, sf), [t.HANDOFF_SOURCE]).vertices
    return v.select("id", "dist", "hops", _path_text().alias("path"))


def q_sssp_hop_limited(spark: SparkSession, sf: str) -> DataFrame:
    return sssp(t.handoff(spark, sf), [t.HANDOFF_SOURCE], max_iterations=HOP_LIMIT).vertices


def q_sssp_labelled(spark: SparkSession, sf: str) -> DataFrame:
    costs = sssp(t.handoff(spark, sf), [t.HANDOFF_SOURCE]).vertices
    source = F.lit(t.HANDOFF_SOURCE).cast("long").alias("source")
    return labelled_costs(costs.select("id", "dist", source), t.customer_labels(spark, sf))


def q_sssp_path_labels(spark: SparkSession, sf: str) -> DataFrame:
    paths = sssp_paths(t.handoff(spark, sf), [t.HANDOFF_SOURCE]).vertices
    return path_labels(paths, t.customer_labels(spark, sf))


def q_max_reach_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Max reach whose send reads both ends of an edge."""
    return max_reach(t.turns(spark, sf), guarded=True).vertices


def q_named_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edge view of a graph with text ids and a text edge property."""
    return t.nation_names(spark, sf).edges


def q_vertex_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_vertices(t.customer_nations(spark, sf)).vertices


def q_edge_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first edges in key order, as a console preview shows them."""
    return preview(t.handoff(spark, sf), "edges", PREVIEW_ROWS)


def q_superstep_trace(spark: SparkSession, sf: str) -> DataFrame:
    """Per superstep of the shortest-path search: active senders, messages,
    receivers and changed vertices (the timing column is left out: it is the
    only non-repeatable one)."""
    res = sssp(t.handoff(spark, sf), [t.HANDOFF_SOURCE])
    return res.trace.select("superstep", "active", "messages", "receivers", "changed")


def q_reach_back_handoff(spark: SparkSession, sf: str) -> DataFrame:
    """The largest event count among the users that a user's handoffs reach: the
    edges taken backwards."""
    return max_reach(t.handoff_counts(spark, sf), direction="in").vertices


def q_max_component_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The longest text among connected turns: edges taken both ways, each sending to
    whichever end is behind."""
    return max_reach(t.turns(spark, sf), direction="either", guarded=True).vertices


def q_handoff_strength(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of a user's handoffs, in and out: messages to both ends of an edge."""
    return strength(t.handoff(spark, sf)).vertices


def q_walk_counts_trade(spark: SparkSession, sf: str) -> DataFrame:
    """Walks of at most three edges from the smallest source: messages are summed, and
    whoever receives sends on."""
    return walk_counts(t.trade_top3(spark, sf), t.smallest_source, HOP_LIMIT).vertices


def q_cost_there_and_back(spark: SparkSession, sf: str) -> DataFrame:
    """Cheapest cost from the source to each user and back to it: two searches, along
    and against the edges, over one prepared graph."""
    graph = PreparedGraph(t.handoff(spark, sf), directions=("out", "in"), edge_min_columns=("weight",))
    there = sssp(graph, [t.HANDOFF_SOURCE]).vertices.withColumnRenamed("dist", "there")
    back = sssp(graph, [t.HANDOFF_SOURCE], direction="in").vertices.withColumnRenamed("dist", "back")
    graph.release()
    return there.join(back, "id").select("id", "there", "back", (F.col("there") + F.col("back")).alias("round_trip"))


def q_sssp_guarded_handoff(spark: SparkSession, sf: str) -> DataFrame:
    """Shortest costs whose relaxation is tested on the edge, before the shuffle."""
    return sssp(t.handoff(spark, sf), [t.HANDOFF_SOURCE], guarded=True).vertices


def q_sssp_signed_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Cheapest cost over weights of either sign (how much longer a turn's text is than
    the one before it), watched for negative cycles."""
    return sssp(t.signed_turns(spark, sf), t.turn_starts(), allow_negative=True).vertices


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trade_vertices": q_trade_vertices,
    "trade_edges": q_trade_edges,
    "handoff_edges": q_handoff_edges,
    "turns_edges": q_turns_edges,
    "triplets": q_triplets,
    "vertex_fill": q_vertex_fill,
    "max_reach_trade_top3": q_max_reach_trade_top3,
    "max_reach_turns": q_max_reach_turns,
    "global_max": q_global_max,
    "sssp_trade": q_sssp_trade,
    "sssp_trade_top3": q_sssp_trade_top3,
    "sssp_handoff": q_sssp_handoff,
    "sssp_turns": q_sssp_turns,
    "sssp_paths_handoff": q_sssp_paths_handoff,
    "sssp_hop_limited": q_sssp_hop_limited,
    "sssp_labelled": q_sssp_labelled,
    "sssp_path_labels": q_sssp_path_labels,
    "superstep_trace": q_superstep_trace,
    "max_reach_guarded": q_max_reach_guarded,
    "named_edges": q_named_edges,
    "vertex_dedupe": q_vertex_dedupe,
    "edge_preview": q_edge_preview,
    "reach_back_handoff": q_reach_back_handoff,
    "max_component_turns": q_max_component_turns,
    "handoff_strength": q_handoff_strength,
    "walk_counts_trade": q_walk_counts_trade,
    "cost_there_and_back": q_cost_there_and_back,
    "sssp_guarded_handoff": q_sssp_guarded_handoff,
    "sssp_signed_turns": q_sssp_signed_turns,
}
