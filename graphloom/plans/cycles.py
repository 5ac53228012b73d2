"""Negative cycles, found while costs still fall.

Every vertex whose cost came over an edge points at the source of its cheapest
in-edge, (cost + weight, superstep of the source's last change, id) at least.
Such an edge is never longer than the difference of its ends' costs, so a cycle
of pointers weighs at most 0, and less than 0 if some cost on it is about to
fall.  Without such a cycle every cost is one of a walk that repeats no vertex,
so a reachable negative cycle shows as soon as costs fall below those walks'.

Pointers are doubled until none is left (no cycle) or each of them spans more
vertices than there are: what it then points at lies on a cycle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.operators.joins import lookup_join
from graphloom.operators.pregel import Progress

CHECK_EVERY = 16  # rounds between two looks for a cycle
NAMED = 100  # vertices that an error lists


class NegativeCycle(ValueError):
    """Costs fall forever.  ``vertices``: ids on negative cycles, in order, at most
    ``NAMED`` of the ``total``."""

    def __init__(self, vertices: list, total: int, rounds: int):
        self.vertices, self.total, self.rounds = vertices, total, rounds
        more = "" if total <= len(vertices) else f" and {total - len(vertices)} more"
        super().__init__(f"negative cycle reachable from a source, through the vertices {vertices}{more} (seen after {rounds} rounds)")


def _cost(settled: DataFrame) -> Column:
    return F.col("state.dist") if isinstance(settled.schema["state"].dataType, StructType) else F.col("state")


def pointers(settled: DataFrame, edges: DataFrame, weight_col: str) -> DataFrame:
    """(id, up, falls): the source of each vertex's cheapest in-edge, and whether the
    vertex's cost falls by it in the next round.  Sources that no edge improves have no row."""
    ends = settled.select("id", _cost(settled).alias("_cost"), "since").where(F.col("_cost").isNotNull())
    near = ends.select(F.col("id").alias("src"), F.col("_cost").alias("_from"), F.col("since").alias("_hop"))
    offer = F.struct((F.col("_from") + F.col(weight_col)).alias("cost"), F.col("_hop").alias("hop"), F.col("src").alias("up"))
    offers = (
        edges.where(F.col(weight_col).isNotNull())
        .join(near, "src")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.min(offer).alias("_best"))
    )
    falls = F.col("_best.cost") < F.col("_cost")
    return (
        offers.join(ends, "id")
        .where(falls | ((F.col("since") > 0) & (F.col("_best.cost") == F.col("_cost"))))
        .select("id", F.col("_best.up").alias("up"), falls.alias("falls"))
    )


def on_negative_cycles(now: Progress, weight_col: str, direction: str = "out") -> DataFrame | None:
    """(id) of the vertices on negative cycles of the pointers, or None.

    The tables that it writes are dropped, but for the one that the result reads
    (it goes with the run's)."""
    store = now.store
    edges = now.edges.select("src", "dst", weight_col)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), weight_col)
    edges = {"out": edges, "in": back}.get(direction, edges.unionByName(back))
    count = F.count(F.lit(1)).alias("n")
    key = f"cycle_{now.rounds}_0"
    jumps, seen = store.write_table(pointers(now.settled, edges, weight_col), key, count, bucket="id")
    total = open_ = int(seen["n"])
    span = 1
    while open_ and span < total:
        # a pointer whose target has none ends in a source: it drops out
        above = jumps.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("falls").alias("_falls"))
        longer = lookup_join(jumps, above, "up", "up").select("id", F.col("_up").alias("up"), (F.col("falls") | F.col("_falls")).alias("falls"))
        span *= 2
        last, key = key, f"cycle_{now.rounds}_{span}"
        jumps, seen = store.write_table(longer, key, count, bucket="id")
        open_ = int(seen["n"])
        store.drop(last)
    # a pointer of a cycle now spans all of it: a fall anywhere on it shows
    found = jumps.select(F.col("up").alias("id")).distinct().join(jumps.where("falls").select("id"), "id") if open_ else None
    if found is None or found.isEmpty():
        store.drop(key)
        return None
    return found


def raise_on_negative_cycle(now: Progress, weight_col: str, direction: str = "out") -> None:
    """To be called after every round: looks every ``CHECK_EVERY`` rounds, and when
    there were as many rounds as vertices."""
    if now.rounds % CHECK_EVERY and now.rounds != now.vertex_count:
        return
    found = on_negative_cycles(now, weight_col, direction)
    if found is not None:
        total = found.count()
        raise NegativeCycle([r["id"] for r in found.orderBy("id").limit(NAMED).collect()], total, now.rounds)
