"""Edge cases of the Pregel loop and the algorithms."""
import pytest
from pyspark.sql import functions as F

from graphloom import PropertyGraph, max_reach, sssp, sssp_paths


def graph(spark, vertices, edges, vtype="long"):
    v = spark.createDataFrame([(x,) for x in vertices], f"id {vtype}")
    e = spark.createDataFrame(edges, f"src {vtype}, dst {vtype}, weight long")
    return PropertyGraph(v, e)


def costs(res):
    return {r.id: r.dist for r in res.vertices.collect()}


def test_no_edges(spark):
    res = sssp(graph(spark, [1, 2], []), [1])
    assert costs(res) == {1: 0, 2: None}
    assert res.converged


def test_self_loop_and_parallel_edges(spark):
    g = graph(spark, [1, 2], [(1, 1, 1), (1, 2, 7), (1, 2, 3), (1, 2, 5)])
    assert costs(sssp(g, [1])) == {1: 0, 2: 3}


def test_unreachable_and_missing_source(spark):
    g = graph(spark, [1, 2, 3], [(1, 2, 1)])
    assert costs(sssp(g, [1])) == {1: 0, 2: 1, 3: None}
    assert costs(sssp(g, [99])) == {1: None, 2: None, 3: None}


def test_unknown_endpoint_becomes_unreached_vertex(spark):
    g = graph(spark, [1, 2], [(1, 2, 1), (7, 1, 1), (2, 8, 4)])
    assert costs(sssp(g, [1])) == {1: 0, 2: 1, 7: None, 8: 5}


def test_fill_missing_and_dedupe(spark):
    v = spark.createDataFrame([(1, "a", 5), (1, "b", 3), (2, "c", 1)], "id long, name string, value long")
    e = spark.createDataFrame([(1, 3, 1)], "src long, dst long, weight long")
    g = PropertyGraph(v, e).dedupe_vertices()
    assert sorted(g.vertices.collect()) == [(1, "a", 5), (2, "c", 1)]
    filled = g.fill_missing({"value": 0}).vertices.collect()
    assert sorted(filled, key=lambda r: r.id) == [(1, "a", 5), (2, "c", 1), (3, None, 0)]


def test_null_endpoint_dropped(spark):
    e = spark.createDataFrame([(1, None, 1), (None, 2, 1), (1, 2, 2)], "src long, dst long, weight long")
    v = spark.createDataFrame([(1,), (2,)], "id long")
    res = sssp(PropertyGraph(v, e), [1])
    assert costs(res) == {1: 0, 2: 2}
    assert res.edge_stats["edges"] == 1


def test_zero_weight_cycle_terminates(spark):
    g = graph(spark, [1, 2, 3], [(1, 2, 0), (2, 3, 0), (3, 1, 0), (3, 2, 0)])
    res = sssp_paths(g, [1])
    got = {r.id: (r.dist, list(r.path)) for r in res.vertices.collect()}
    assert got == {1: (0, [1]), 2: (0, [1, 2]), 3: (0, [1, 2, 3])}
    assert res.converged


def test_negative_weight_rejected(spark):
    g = graph(spark, [1, 2], [(1, 2, -1)])
    with pytest.raises(ValueError, match="negative edge weight"):
        sssp(g, [1])
    assert costs(sssp(g, [1], allow_negative=True)) == {1: 0, 2: -1}


def test_negative_cycle_detected(spark):
    g = graph(spark, [1, 2], [(1, 2, 1), (2, 1, -3)])
    with pytest.raises(ValueError, match="negative cycle"):
        sssp(g, [1], allow_negative=True)


def test_iteration_cap(spark):
    g = graph(spark, [1, 2, 3, 4], [(1, 2, 1), (2, 3, 1), (3, 4, 1), (1, 4, 10)])
    res = sssp(g, [1], max_iterations=2)
    assert costs(res) == {1: 0, 2: 1, 3: 2, 4: 10}
    assert not res.converged and res.rounds == 2


def test_ties_prefer_fewer_hops_then_smaller_path(spark):
    # 1->4 costs 2 directly or via 2 or 3 (2 hops); 1->5 via 2 or 3 at equal hops
    g = graph(spark, [1, 2, 3, 4, 5], [(1, 4, 2), (1, 2, 1), (2, 4, 1), (1, 3, 1), (3, 4, 1), (3, 5, 1), (2, 5, 1)])
    got = {r.id: (r.dist, r.hops, list(r.path)) for r in sssp_paths(g, [1]).vertices.collect()}
    assert got[4] == (2, 1, [1, 4])
    assert got[5] == (2, 2, [1, 2, 5])


def test_string_ids(spark):
    g = graph(spark, ["a", "b", "c"], [("a", "b", 2), ("b", "c", 2), ("a", "c", 5)], vtype="string")
    assert costs(sssp(g, ["a"])) == {"a": 0, "b": 2, "c": 4}
    res = sssp_paths(g, ["a"])
    assert {r.id: list(r.path) for r in res.vertices.collect()}["c"] == ["a", "b", "c"]


def test_several_sources_as_frame(spark):
    g = graph(spark, [1, 2, 3, 4], [(1, 2, 5), (3, 2, 1), (2, 4, 1)])
    srcs = spark.createDataFrame([(1,), (3,), (3,)], "id long")
    assert costs(sssp(g, srcs)) == {1: 0, 2: 1, 3: 0, 4: 2}


def test_max_reach_null_values_and_mixed_types_checked(spark):
    v = spark.createDataFrame([(1, None), (2, 4), (3, 1)], "id long, value long")
    e = spark.createDataFrame([(2, 1, 0), (1, 3, 0)], "src long, dst long, weight long")
    res = max_reach(PropertyGraph(v, e))
    assert dict(res.vertices.collect()) == {1: 4, 2: 4, 3: 4}
    with pytest.raises(TypeError):
        PropertyGraph(spark.createDataFrame([(1,)], "id int"), e)


def test_hub_split_gives_same_result(spark):
    # vertex 0 holds almost all edges: it is split off as a hub
    edges = [(0, i, i % 5 + 1) for i in range(1, 300)] + [(i, i + 1, 1) for i in range(1, 20)]
    g = graph(spark, list(range(300)), edges)
    res = sssp(g, [0])
    expect = {0: 0}
    for i in range(1, 300):
        expect[i] = i % 5 + 1
    for i in range(2, 21):
        expect[i] = min(expect[i], expect[i - 1] + 1)
    assert costs(res) == expect
    assert res.edge_stats["max_out_degree"] == 299
    res2 = max_reach(PropertyGraph(spark.range(300).select("id", F.col("id").alias("value")), g.edges))
    assert dict(res2.vertices.collect())[5] == 5


def test_hot_message_target(spark):
    # almost every vertex sends to vertex 0: merged map-side, one value survives
    n = 400
    v = spark.createDataFrame([(i, i % 37) for i in range(n)], "id long, value long")
    e = spark.createDataFrame([(i, 0, 1) for i in range(1, n)] + [(0, 1, 1)], "src long, dst long, weight long")
    res = max_reach(PropertyGraph(v, e))
    got = dict(res.vertices.collect())
    assert got[0] == 36 and got[1] == 36
    assert all(got[i] == i % 37 for i in range(2, n))


def test_null_weights_carry_nothing(spark):
    g = graph(spark, [1, 2, 3], [(1, 2, None), (1, 2, 5), (2, 3, 1)])
    costs = {r.id: r.dist for r in sssp(g, [1]).vertices.collect()}
    paths = {r.id: (r.dist, r.path) for r in sssp_paths(g, [1]).vertices.collect()}
    assert costs == {1: 0, 2: 5, 3: 6}
    assert paths == {1: (0, [1]), 2: (5, [1, 2]), 3: (6, [1, 2, 3])}


def test_sources_by_vertex_property(spark):
    v = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("a", 5)], "id string, turn int")
    e = spark.createDataFrame([("a", "b", 2), ("b", "c", 2)], "src string, dst string, weight long")
    g = PropertyGraph(v, e)
    assert dict(sssp(g, F.col("turn") == 0).vertices.collect()) == {"a": 0, "b": 2, "c": 4}
    assert dict(sssp(g, F.col("turn") == 1).vertices.collect()) == {"a": None, "b": 0, "c": 2}


def test_long_conversations_keep_their_turns_apart(spark, tmp_path):
    from graphloom.plans.catalog import QUERIES

    rows = [(1, t, "user", "x" * (t % 7 + 1)) for t in range(1003)] + [(2, t, "user", "yy") for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    edges = QUERIES["turns_edges"](spark, str(tmp_path)).collect()
    assert len(edges) == 1003 and {("1:999", "1:1000"), ("2:0", "2:1")} <= {(r.src, r.dst) for r in edges}
    from graphloom.plans.algorithms import max_reach
    from graphloom.sources import tables as t

    graph_ = t.turns(spark, str(tmp_path))
    reach = dict(max_reach(graph_, max_iterations=3).vertices.collect())
    assert len(reach) == 1005 and reach["2:1"] == 2 and reach["1:1000"] == 7
    costs = dict(sssp(graph_, t.turn_starts(), max_iterations=2).vertices.collect())
    assert costs["2:0"] == 0 and costs["1:1000"] is None and sum(c == 0 for c in costs.values()) == 2
