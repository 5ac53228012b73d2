"""Shortest paths from settled costs: predecessors, ties, paths by pointer doubling.

The search itself keeps one number a vertex.  In synchronous rounds a vertex's
cost last falls in the round that equals the edges of its best walk, so the
settled state has cost and hops; the predecessors of a vertex are the sources of
its tight edges (cost + weight = cost, hops + 1 = hops).  No state or message
grows with the length of a path.

Up to ``CARRY_EDGES`` edges, counted as they are written, the states carry their
paths instead, which takes fewer jobs.

Several predecessors are settled by the order of their paths.  Paths of equally
many hops compare like (rank of the predecessor's path, own id), so a layer of
vertices is ranked from the layer before it, up to the last layer with a tie.
Paths are then put together from pieces that double in length.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.pregel import PregelResult

CARRY_EDGES = 1_000_000  # up to so many edges a search carries its paths in the states
SORT_ROWS = 200_000  # rows of all layers that one task may sort


def tight_edges(settled: DataFrame, edges: DataFrame, weight_col: str) -> DataFrame:
    """(id, hop, pred): the last edges of cheapest walks with the fewest hops.

    ``settled``: (id, state = cost, since = hops).  The edges meet the costs of
    their sources where they lie; what is left of them is shuffled once by target.
    """
    ends = settled.where(F.col("state").isNotNull())
    sources = ends.select(F.col("id").alias("src"), F.col("state").alias("_cost"), F.col("since").alias("_hop"))
    reach = (
        edges.where(F.col(weight_col).isNotNull())
        .join(sources, "src")
        .select(F.col("dst").alias("id"), F.col("src").alias("pred"), (F.col("_cost") + F.col(weight_col)).alias("_cost"), (F.col("_hop") + 1).alias("hop"))
    )
    mine = ends.where("since > 0").select("id", F.col("state").alias("_cost"), F.col("since").alias("hop"))
    return reach.join(mine, ["id", "_cost", "hop"]).select("id", "hop", "pred")


def _ranked(rows: DataFrame, order: list[str], small: bool) -> DataFrame:
    """``rows`` plus ``rank``, a number that grows with ``order``."""
    if small:  # a checked number of rows: one task sorts them within the job
        return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    # ranges in order, rows in order inside a range: so are these ids
    return rows.orderBy(*order).withColumn("rank", F.monotonically_increasing_id())


def predecessors(result: PregelResult, weight_col: str) -> tuple[DataFrame, int]:
    """((id, hop, pred) of every reached vertex that is no source, largest hop): the
    predecessor on the cheapest path, ties by hops and then by the path's ids."""
    store = result._store
    tight = tight_edges(result.settled, result.edges, weight_col)
    per = tight.groupBy("id", "hop").agg(F.min("pred").alias("pred"), F.max("pred").alias("last"))
    tie = F.col("pred") != F.col("last")
    per, seen = store.write_table(
        per, "predecessors", F.max("hop").alias("deepest"), F.max(F.when(tie, F.col("hop"))).alias("tied"), F.count(F.lit(1)).alias("rows"), bucket="id"
    )
    deepest, tied = int(seen["deepest"] or 0), int(seen["tied"] or 0)
    chosen = per.select("id", "hop", "pred")
    if not tied:
        return chosen, deepest
    small = int(seen["rows"]) <= SORT_ROWS
    layers, _ = store.write_table(tight.where(F.col("hop") <= tied).distinct(), "tight")
    first = result.settled.where(F.col("state").isNotNull() & (F.col("since") == 0)).select("id")
    # sources may be many, but their ids are their order
    ranks = first.select("id", F.col("id").alias("rank"))
    out = chosen.where(F.col("hop") > tied)
    for hop in range(1, tied + 1):
        met = layers.where(F.col("hop") == hop).join(ranks.select(F.col("id").alias("pred"), F.col("rank").alias("_before")), "pred")
        best = met.groupBy("id", "hop").agg(F.min(F.struct("_before", "pred")).alias("_best"))
        layer = _ranked(best.select("id", "hop", "_best.pred", "_best._before"), ["_before", "id"], small).drop("_before")
        layer, _ = store.write_table(layer, f"layer_{hop}")
        out = out.unionByName(layer.select("id", "hop", "pred"))
        ranks = layer.select("id", "rank")
    out, _ = store.write_table(out, "chosen", bucket="id")
    for key in [k for k in store.tables if k == "tight" or k.startswith("layer_")]:
        store.drop(key)
    return out, deepest


def paths(result: PregelResult, weight_col: str) -> DataFrame:
    """(id, dist, hops, path) from a converged search that kept its edges."""
    store = result._store
    pred, deepest = predecessors(result, weight_col)
    first = F.col("hop") == 1  # its predecessor is a source: the path is complete
    own = F.array("id")
    piece = F.when(first, F.concat(F.array("pred"), own)).otherwise(own)
    pieces = pred.select("id", F.when(~first, F.col("pred")).alias("up"), piece.alias("path"))
    steps = max(0, (deepest - 1).bit_length())
    for k in range(1, steps + 1):
        open_ = pieces.where(F.col("up").isNotNull())
        above = pieces.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        longer = open_.join(above, "up").select("id", F.col("_up").alias("up"), F.concat("_path", "path").alias("path"))
        pieces = pieces.where(F.col("up").isNull()).unionByName(longer)
        if k < steps:
            pieces, _ = store.write_table(pieces, f"pieces_{k}", bucket="id")
    pieces, _ = store.write_table(pieces.select("id", F.col("path").alias("_path")), "paths", bucket="id")
    done = ("pieces_", "predecessors", "chosen", *(() if store.run else ("edges",)))  # a named run may be asked again
    for key in [k for k in store.tables if k.startswith(done)]:
        store.drop(key)
    reached = F.col("state").isNotNull()
    joined = result.settled.join(pieces, "id", "left")
    return joined.select(
        "id",
        F.col("state").alias("dist"),
        F.when(reached, F.col("since")).alias("hops"),
        F.when(reached, F.coalesce("_path", F.array("id"))).alias("path"),
    )
