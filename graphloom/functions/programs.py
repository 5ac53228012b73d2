"""The vertex programs, written as JVM-side Column expressions.

Where states only ever improve (max grows, cost shrinks), ``update`` is a lattice
join and a vertex is active in the next round exactly when its state changed;
sums are active where a message arrived.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.operators.pregel import VertexProgram, messages


def spread_max() -> VertexProgram:
    """Carry the largest value along edges (send own value, merge max, keep max).

    A message that is not larger than the receiver's value changes nothing, so
    the receiver stays inactive -- the same effect as the "send only if larger"
    test on the triplet, without a join to the destination's state.
    """
    return VertexProgram(
        send=lambda src: src,
        merge=F.max,
        update=lambda state, msg: F.greatest(state, msg),
    )


def spread_larger(*, backwards: bool = False) -> VertexProgram:
    """As :func:`spread_max`, but the send reads the receiver's value too and sends
    only what is larger: fewer messages are merged, for one more look at the
    receivers' states.  ``backwards``: from ``dst`` to ``src``."""

    def larger(sender: Column, receiver: Column) -> Column:
        return F.when(receiver.isNull() | (sender > receiver), sender)

    return VertexProgram(
        send=lambda src: src,
        merge=F.max,
        update=lambda state, msg: F.greatest(state, msg),
        send_triplet=lambda src, dst: larger(dst, src) if backwards else larger(src, dst),
    )


def spread_larger_both() -> VertexProgram:
    """As :func:`spread_larger` over undirected edges: an edge sends the larger of
    its ends' values to the other end, whichever that is."""
    return VertexProgram(
        send=None,
        merge=F.max,
        update=lambda state, msg: F.greatest(state, msg),
        send_all=lambda src, dst: messages(
            to_dst=F.when(dst.isNull() | (src > dst), src), to_src=F.when(src.isNull() | (dst > src), dst)
        ),
    )


def sum_both_ends(weight_col: str = "weight") -> VertexProgram:
    """Every edge sends its weight to both of its ends; messages are added up."""
    return VertexProgram(
        send=None,
        merge=F.sum,
        update=lambda state, msg: state + msg,
        send_all=lambda src, dst: messages(to_src=F.col(weight_col), to_dst=F.col(weight_col)),
        active_on="received",
    )


def add_walks() -> VertexProgram:
    """State ``struct(total, fresh)``: walks so far, and those that arrived in the last
    round, which are sent on."""
    return VertexProgram(
        send=lambda state: state["fresh"],
        merge=F.sum,
        update=lambda state, msg: F.struct((state["total"] + msg).alias("total"), msg.alias("fresh")),
        active_on="received",
    )


def relax_min(weight_col: str = "weight") -> VertexProgram:
    """Shortest cost: send cost + weight, keep the minimum (strict improvement)."""
    return VertexProgram(
        send=lambda src: src + F.col(weight_col),
        merge=F.min,
        update=lambda state, msg: F.least(state, msg),
    )


def relax_min_guarded(weight_col: str = "weight", *, backwards: bool = False) -> VertexProgram:
    """As :func:`relax_min`, but the relaxation is tested on the edge: only a cost that
    improves the receiver's is sent, for one more look at the receivers' states.
    ``backwards``: from ``dst`` to ``src``."""

    def relaxed(sender: Column, receiver: Column) -> Column:
        cost = sender + F.col(weight_col)
        return F.when(receiver.isNull() | (cost < receiver), cost)

    return VertexProgram(
        send=lambda src: src + F.col(weight_col),
        merge=F.min,
        update=lambda state, msg: F.least(state, msg),
        send_triplet=lambda src, dst: relaxed(dst, src) if backwards else relaxed(src, dst),
    )


def relax_path(weight_col: str = "weight") -> VertexProgram:
    """Shortest cost with path: state ``struct(dist, hops, path)``.

    Ordered as a whole: cost first, then hop count, then the path itself
    (lexicographic), so ties are settled the same way on every run and a
    turn around a zero-weight cycle is always worse.
    """

    def send(src: Column) -> Column:
        walk = F.struct(
            (src["dist"] + F.col(weight_col)).alias("dist"),
            (src["hops"] + F.lit(1)).alias("hops"),
            F.array_append(src["path"], F.col("dst")).alias("path"),
        )
        # an edge without a weight, like an unreached source, sends nothing
        return F.when(src["dist"].isNotNull() & F.col(weight_col).isNotNull(), walk)

    return VertexProgram(
        send=send,
        merge=F.min,
        update=lambda state, msg: F.least(state, msg),
    )


def path_start(id_col: Column) -> Column:
    """Start state of a source: cost 0, 0 hops, path = [source]."""
    return F.struct(
        F.lit(0).cast("long").alias("dist"),
        F.lit(0).alias("hops"),
        F.array(id_col).alias("path"),
    )
