"""The named algorithms: max value reaching each vertex, shortest cost, shortest path."""
from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterable
from typing import Any, Union

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.functions.lines import max_line
from graphloom.functions.programs import add_walks, path_start, relax_min, relax_min_guarded, relax_path, spread_larger, spread_larger_both, spread_max, sum_both_ends
from graphloom.graph import PropertyGraph
from graphloom.operators.pregel import PregelResult, PreparedGraph, Progress, VertexProgram, pregel
from graphloom.plans import cycles, paths

Sources = Union[Iterable[Any], DataFrame, Column, Callable[[PropertyGraph], DataFrame]]


def _source_flag(sources: Sources):
    """(vertex hook or None, boolean column marking the source vertices).

    ``sources`` is a list of ids, a DataFrame with an ``id`` column, a
    function of the graph returning such a DataFrame (evaluated on the loop's
    already computed edges, so a derived edge table is not rebuilt), or a
    boolean Column over the vertex table.  Ids that are no vertex are ignored.
    """
    if isinstance(sources, Column):
        return None, F.coalesce(sources, F.lit(False))
    if isinstance(sources, DataFrame) or callable(sources):

        def hook(v: DataFrame, graph: PropertyGraph) -> DataFrame:
            ids = sources(graph) if callable(sources) else sources
            flags = ids.select("id").where(F.col("id").isNotNull()).distinct().withColumn("_source", F.lit(True))
            return v.join(flags, "id", "left")

        return hook, F.coalesce(F.col("_source"), F.lit(False))
    ids = list(sources)
    if not ids:
        return None, F.lit(False)
    return None, F.col("id").isin(ids)


def _renamed(result: PregelResult, vertices: DataFrame) -> PregelResult:
    return dataclasses.replace(result, vertices=vertices)


def max_reach(
    graph: PropertyGraph | PreparedGraph,
    value_col: str = "value",
    *,
    max_iterations: int | None = None,
    guarded: bool = False,
    direction: str = "out",
) -> PregelResult:
    """For every vertex, the largest ``value_col`` among the vertices that reach
    it along directed edges (itself included).  Result vertices: (id, value_col).

    ``direction``: "in" takes the edges backwards (the largest value that a vertex
    reaches), "either" both ways (the largest of its weak component).
    Endpoints missing from the vertex table join with a NULL value.  With
    ``guarded`` a vertex sends only to neighbours whose value is smaller.
    """
    if not isinstance(graph, PreparedGraph):
        graph = PropertyGraph(graph.vertices.select("id", value_col), graph.edges.select("src", "dst"))
    program = spread_max()
    if guarded:
        program = spread_larger_both() if direction == "either" else spread_larger(backwards=direction == "in")
    res = pregel(graph, program, state=F.col(value_col), max_iterations=max_iterations, direction=direction)
    return _renamed(res, res.vertices.select("id", F.col("state").alias(value_col)))


def global_max(graph: PropertyGraph, value_col: str = "value") -> DataFrame:
    """The maximum value in the graph: one row (max_value, line).  A converged
    max-reach state has the same maximum, so one aggregate is enough."""
    top = graph.vertices.agg(F.max(value_col).alias("max_value"))
    return top.select("max_value", max_line(F.col("max_value")).alias("line"))


def _check_weights(weight_col: str, allow_negative: bool):
    def check(stats: Row, _vertices: int) -> None:
        low = stats[f"min_{weight_col}"]
        if low is not None and low < 0 and not allow_negative:
            raise ValueError(
                f"negative edge weight {low} in '{weight_col}'; pass allow_negative=True "
                "to run Bellman-Ford, which raises NegativeCycle on a negative cycle"
            )

    return check


def _shortest(
    graph: PropertyGraph | PreparedGraph,
    sources: Sources,
    weight_col: str,
    by_size: Callable[[int], tuple[VertexProgram, Column, Column]],
    max_iterations: int | None,
    allow_negative: bool,
    direction: str,
    keep_edges: bool = False,
    resume: str | None = None,
) -> PregelResult:
    hook, is_source = _source_flag(sources)
    g = graph
    if not isinstance(graph, PreparedGraph):
        vertices = graph.vertices.select("id")
        if isinstance(sources, Column):
            # evaluated where the vertex properties are; the smallest flag of a repeated id wins
            vertices = graph.vertices.select("id", (~is_source).alias("_other"))
            is_source = ~F.coalesce(F.col("_other"), F.lit(True))
        g = PropertyGraph(vertices, graph.edges.select("src", "dst", weight_col))
    negative_guard = allow_negative and max_iterations is None

    def watch(now: Progress) -> None:
        low = now.edge_stats[f"min_{weight_col}"]
        if low is not None and low < 0:
            cycles.raise_on_negative_cycle(now, weight_col, direction)

    def chosen(edges: int) -> tuple[VertexProgram, Column]:
        program, start, none = by_size(edges)
        return program, F.when(is_source, start).otherwise(none)

    res = pregel(
        g,
        None,
        state=None,
        by_size=chosen,
        max_iterations=max_iterations,
        after_round=watch if negative_guard else None,
        prepare_vertices=hook,
        edge_min_columns=(weight_col,),
        validate=_check_weights(weight_col, allow_negative),
        direction=direction,
        keep_edges=keep_edges,
        resume=resume,
    )
    return res


def _costs_only(weight_col: str, program: VertexProgram | None = None) -> tuple[VertexProgram, Column, Column]:
    return program or relax_min(weight_col), F.lit(0).cast("long"), F.lit(None).cast("long")


def sssp(
    graph: PropertyGraph | PreparedGraph,
    sources: Sources,
    weight_col: str = "weight",
    *,
    max_iterations: int | None = None,
    allow_negative: bool = False,
    direction: str = "out",
    guarded: bool = False,
    resume: str | None = None,
) -> PregelResult:
    """Cheapest cost from the nearest source.  Result vertices: (id, dist);
    ``dist`` is NULL where no source reaches the vertex.  With
    ``max_iterations = k`` the cost uses walks of at most ``k`` edges.
    ``direction`` "in" follows the edges backwards (the cost to the nearest
    source), "either" both ways.

    With ``allow_negative`` weights may be negative; a negative cycle that a source
    reaches raises :class:`~graphloom.plans.cycles.NegativeCycle` soon after costs
    have gone around it.  With ``guarded`` a vertex sends only costs that improve
    the receiver's.  ``resume`` names the run, which then goes on after a loss of
    the driver (see :func:`~graphloom.operators.pregel.pregel`)."""
    if guarded and direction == "either":
        raise ValueError("a guarded search follows the edges in one direction")
    program = relax_min_guarded(weight_col, backwards=direction == "in") if guarded else None
    res = _shortest(
        graph,
        sources,
        weight_col,
        lambda _edges: _costs_only(weight_col, program),
        max_iterations,
        allow_negative,
        direction,
        resume=resume,
    )
    return _renamed(res, res.vertices.select("id", F.col("state").alias("dist")))


def sssp_paths(
    graph: PropertyGraph | PreparedGraph,
    sources: Sources,
    weight_col: str = "weight",
    *,
    max_iterations: int | None = None,
    allow_negative: bool = False,
    resume: str | None = None,
) -> PregelResult:
    """Cheapest cost and the path achieving it (starting with its source).

    Result vertices: (id, dist, hops, path).  Among equal costs the path with
    fewer hops wins, then the lexicographically smaller one.

    The states of a large graph keep costs only, and the paths are made after the
    search (:mod:`graphloom.plans.paths`); those of a small one carry their paths.
    So do states under ``max_iterations = k``, where a vertex's path may go by an
    older, longer way than its predecessor's: they have at most k edges.
    """

    def by_size(edges: int) -> tuple[VertexProgram, Column, Column]:
        if max_iterations is None and edges > paths.CARRY_EDGES:
            return _costs_only(weight_col)
        return relax_path(weight_col), path_start(F.col("id")), F.lit(None)

    keep = max_iterations is None
    res = _shortest(graph, sources, weight_col, by_size, max_iterations, allow_negative, "out", keep_edges=keep, resume=resume)
    if isinstance(res.settled.schema["state"].dataType, StructType):
        res.release_edges()
        v = res.vertices.select("id", "state.dist", "state.hops", "state.path")
        return _renamed(res, v)
    try:
        return _renamed(res, paths.paths(res, weight_col))
    except BaseException:
        res.release()
        raise


def strength(graph: PropertyGraph | PreparedGraph, weight_col: str = "weight") -> PregelResult:
    """Sum of the weights of a vertex's edges, at both ends (a self-loop counts
    twice; 0 without edges): one superstep in which every edge sends a message to
    each end.  Result vertices: (id, strength)."""
    g = graph
    if not isinstance(graph, PreparedGraph):
        g = PropertyGraph(graph.vertices.select("id"), graph.edges.select("src", "dst", weight_col))
    res = pregel(g, sum_both_ends(weight_col), state=F.lit(0).cast("long"), active=F.lit(True), max_iterations=1)
    return _renamed(res, res.vertices.select("id", F.col("state").alias("strength")))


def walk_counts(graph: PropertyGraph | PreparedGraph, sources: Sources, length: int) -> PregelResult:
    """Number of walks of 1 to ``length`` edges from any source to each vertex.

    Messages are summed, and a vertex sends on what it received in the last
    round, changed or not.  Parallel edges make walks of their own.  Result
    vertices: (id, walks).
    """
    hook, is_source = _source_flag(sources)
    g = graph
    if not isinstance(graph, PreparedGraph):
        vertices = graph.vertices.select("id")
        if isinstance(sources, Column):
            vertices = graph.vertices.select("id", (~is_source).alias("_other"))
            is_source = ~F.coalesce(F.col("_other"), F.lit(True))
        g = PropertyGraph(vertices, graph.edges.select("src", "dst"))
    fresh = F.when(is_source, F.lit(1)).otherwise(F.lit(0)).cast("long")
    state = F.struct(F.lit(0).cast("long").alias("total"), fresh.alias("fresh"))
    res = pregel(g, add_walks(), state=state, active=is_source, max_iterations=length, prepare_vertices=hook)
    return _renamed(res, res.vertices.select("id", F.col("state.total").alias("walks")))
