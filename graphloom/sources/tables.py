"""Graphs built from the driver's Parquet tables.

Only the needed columns are read (the scans show them in ``ReadSchema``),
every aggregation is partial first, and building a graph runs no job.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.graph import PropertyGraph
from graphloom.operators.sequence import successor_pairs
from graphloom.operators.topk import top_k_per_group

# Fixed values of the derived graphs.
HANDOFF_SOURCE = 0  # user id the handoff searches start from
TRADE_TOP_K = 3  # heaviest targets kept per source nation
HOLE_REGION = 4  # region whose nations are left out of trade_holes
FILL_VALUE = 1  # value of a vertex added for a missing endpoint


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


# trade ------------------------------------------------------------------------
def trade_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations: (id, name, value = number of customers, 0 if none)."""
    customers = (
        read(spark, sf_dir, "customer", "c_nationkey")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("value"))
    )
    nation = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return (
        nation.join(customers, nation.n_nationkey == customers.c_nationkey, "left")
        .select(
            F.col("n_nationkey").cast("long").alias("id"),
            F.col("n_name").alias("name"),
            F.coalesce(F.col("value"), F.lit(0)).cast("long").alias("value"),
        )
    )


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier nation -> customer nation, weight = number of lineitems."""
    suppliers = read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    customers = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    # dimensions small enough are broadcast by Catalyst; larger ones take a
    # merge join, whose hot keys adaptive execution splits
    items = (
        read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("l_orderkey").alias("orderkey"), "s_nationkey")
    )
    buyers = (
        read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("o_orderkey").alias("orderkey"), "c_nationkey")
    )
    # an order has a handful of lineitems: the orderkey join cannot be skewed
    return (
        items.join(buyers, "orderkey")
        .groupBy(F.col("s_nationkey").cast("long").alias("src"), F.col("c_nationkey").cast("long").alias("dst"))
        .agg(F.count(F.lit(1)).cast("long").alias("weight"))
    )


def trade(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    return PropertyGraph(trade_vertices(spark, sf_dir), trade_edges(spark, sf_dir))


def trade_top3(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """The ``TRADE_TOP_K`` heaviest non-self targets of every source nation
    (ties: smaller ``dst`` first)."""
    e = trade_edges(spark, sf_dir).where(F.col("src") != F.col("dst"))
    top = top_k_per_group(e, "src", [F.col("weight").desc(), F.col("dst").asc()], TRADE_TOP_K, salt_cols=["dst"])
    return PropertyGraph(trade_vertices(spark, sf_dir), top)


def trade_holes(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """``trade`` with the nations of region ``HOLE_REGION`` missing from the
    vertex table (their edges stay)."""
    kept = read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey").where(
        F.col("n_regionkey") != HOLE_REGION
    )
    v = trade_vertices(spark, sf_dir).join(
        kept.select(F.col("n_nationkey").cast("long").alias("id")), "id", "left_semi"
    )
    return PropertyGraph(v, trade_edges(spark, sf_dir))


# turns ------------------------------------------------------------------------
def _turn_graph(spark: SparkSession, sf_dir: str, weight: Column) -> PropertyGraph:
    """Conversation turns as chains: turn t -> turn t + 1 of the same conversation;
    value = text length.  ``weight`` reads both ends' (``src_value``, ``dst_value``)."""
    conv = read(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        "conv_id",
        "turn",
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.length("text").cast("long").alias("value"),
    )
    nxt = conv.select(
        "conv_id",
        (F.col("turn") - 1).alias("turn"),
        F.col("id").alias("dst"),
        F.col("value").alias("dst_value"),
    )
    # (conv_id, turn) is unique on both sides: a long conversation is no hot key
    ends = conv.select("conv_id", "turn", F.col("id").alias("src"), F.col("value").alias("src_value"))
    edges = ends.join(nxt, ["conv_id", "turn"]).select("src", "dst", weight.alias("weight"))
    return PropertyGraph(conv.select("id", "conv_id", "turn", "value"), edges)


def turns(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Conversation turns as chains: turn t -> turn t + 1 of the same
    conversation; value = text length, edge weight = text length of ``dst``.
    A turn's id is the text ``conv_id:turn``."""
    return _turn_graph(spark, sf_dir, F.col("dst_value"))


def signed_turns(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """As ``turns``; edge weight = how much longer ``dst``'s text is than ``src``'s."""
    return _turn_graph(spark, sf_dir, F.col("dst_value") - F.col("src_value"))


def turn_starts() -> Column:
    """Turn 0 of every conversation (the sources of the turns searches)."""
    return F.col("turn") == 0


# handoff ----------------------------------------------------------------------
def handoff_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day, the user of an event -> the user of the next event (by ts, then
    event_id); self-handoffs dropped; weight = the smallest gap in whole
    seconds, at least 1."""
    ev = read(spark, sf_dir, "events", "event_id", "ts", "user_id").select(
        F.to_date("ts").alias("day"),
        "ts",
        "event_id",
        "user_id",
        F.unix_timestamp("ts").alias("sec"),
    )
    # zone-free microseconds since the epoch: grows with ts, so it may cut the
    # order into slices of equal row count (a hot day or second is spread);
    # events of one exact time are cut by their id
    micros = F.col("sec") * F.lit(1_000_000) + F.date_format("ts", "SSSSSS").cast("long")
    pairs = successor_pairs(ev, "day", ["ts", "event_id"], ["user_id", "sec"], slice_key=micros, tie_key=F.col("event_id"))
    return (
        pairs.where(
            F.col("cur_user_id").isNotNull()
            & F.col("next_user_id").isNotNull()
            & (F.col("cur_user_id") != F.col("next_user_id"))
        )
        .groupBy(F.col("cur_user_id").alias("src"), F.col("next_user_id").alias("dst"))
        .agg(F.greatest(F.lit(1), F.min(F.col("next_sec") - F.col("cur_sec"))).cast("long").alias("weight"))
    )


def handoff(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    users = (
        read(spark, sf_dir, "events", "user_id")
        .where(F.col("user_id").isNotNull())
        .distinct()
        .select(F.col("user_id").alias("id"))
    )
    return PropertyGraph(users, handoff_edges(spark, sf_dir))


def handoff_counts(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """``handoff`` with each user's number of events as ``value``."""
    users = read(spark, sf_dir, "events", "user_id").where(F.col("user_id").isNotNull())
    counted = users.groupBy(F.col("user_id").alias("id")).agg(F.count(F.lit(1)).alias("value"))
    return PropertyGraph(counted, handoff_edges(spark, sf_dir))


def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label): names of customers, the users of the handoff graph."""
    return read(spark, sf_dir, "customer", "c_custkey", "c_name").select(
        F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("label")
    )


def nation_names(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """``trade`` by name: text ids, and whether a trade stays in its region as a
    text edge property."""
    nation = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")

    def side(prefix: str) -> DataFrame:
        return nation.select(
            F.col("n_nationkey").cast("long").alias(f"{prefix}_key"),
            F.col("n_name").alias(prefix),
            F.col("n_regionkey").alias(f"{prefix}_region"),
        )

    e = trade_edges(spark, sf_dir).withColumnsRenamed({"src": "src_key", "dst": "dst_key"})
    near = F.col("src_region") == F.col("dst_region")
    edges = e.join(side("src"), "src_key").join(side("dst"), "dst_key").select(
        "src", "dst", F.when(near, "regional").otherwise("overseas").alias("relationship")
    )
    vertices = nation.select(F.col("n_name").alias("id"), F.col("n_regionkey").cast("long").alias("region"))
    return PropertyGraph(vertices, edges)


def customer_nations(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """One vertex row per customer under its nation's id: ids repeat."""
    v = read(spark, sf_dir, "customer", "c_nationkey", "c_custkey", "c_name").select(
        F.col("c_nationkey").cast("long").alias("id"),
        F.col("c_custkey").cast("long").alias("customer"),
        F.col("c_name").alias("name"),
    )
    return PropertyGraph(v, trade_edges(spark, sf_dir))


def smallest_source(graph: PropertyGraph) -> DataFrame:
    """The smallest ``src`` as a one-row source table (stays in Spark)."""
    return graph.edges.agg(F.min("src").alias("id"))
