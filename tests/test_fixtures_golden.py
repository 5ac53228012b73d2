"""Golden values from the reference's built-in literal graphs."""
from pyspark.sql import functions as F

from graphloom import global_max, max_reach, sssp, sssp_paths
from graphloom.plans.report import labelled_costs, path_labels
from graphloom.sources import fixtures as fx


def test_max_value_every_vertex_gets_nine(spark):
    res = max_reach(fx.max_value_graph(spark))
    assert dict(res.vertices.collect()) == {1: 9, 2: 9, 3: 9, 4: 9}
    assert res.converged
    changed = [r.changed for r in res.trace.orderBy("superstep").collect()]
    assert changed == [1, 2, 0]  # {2:9}, then {3:9, 4:9}, then quiet


def test_global_max_line(spark):
    row = global_max(fx.max_value_graph(spark)).collect()[0]
    assert row.max_value == 9
    assert row.line == "9 is the maximum value in the graph"


def test_shortest_costs(spark):
    res = sssp(fx.route_graph(spark), [fx.ROUTE_SOURCE])
    assert dict(res.vertices.collect()) == {1: 0, 2: 4, 3: 2, 4: 9, 5: 5, 6: 20}


def test_costs_improve_after_first_reach(spark):
    res = sssp(fx.route_graph(spark), [1])
    trace = res.trace.orderBy("superstep").collect()
    # vertex 4 is first reached at cost 14 (via 2) and lowered later (via 5)
    assert sum(r.changed for r in trace) > 5
    assert res.converged


def test_shortest_paths(spark):
    res = sssp_paths(fx.route_graph(spark), [1])
    got = {r.id: (r.dist, r.hops, list(r.path)) for r in res.vertices.collect()}
    assert got == {
        1: (0, 0, [1]),
        2: (4, 1, [1, 2]),
        3: (2, 1, [1, 3]),
        4: (9, 3, [1, 3, 5, 4]),
        5: (5, 2, [1, 3, 5]),
        6: (20, 4, [1, 3, 5, 4, 6]),
    }


def test_result_lines(spark):
    res = sssp_paths(fx.route_graph(spark), [1])
    labels = fx.route_labels(spark)
    lines = {r.id: r.line for r in labelled_costs(res.vertices, labels).collect()}
    assert lines[4] == "Minimum cost to get from A to D is 9"
    plines = {r.id: (r.path_labels, r.line) for r in path_labels(res.vertices, labels).collect()}
    assert plines[4] == ("A>C>E>D", "Minimum cost to get from A to D is [1, 3, 5, 4] with cost 9")


def test_social_graph_views(spark):
    g = fx.social_graph(spark)
    assert g.vertices.count() == 7
    assert g.edges.count() == 8
    ends = {r.id for r in g.edges.select(F.col("src").alias("id")).union(g.edges.select("dst")).collect()}
    assert "g" not in ends
    desc = [(r.side, r.position, r.column, r.type) for r in g.describe().orderBy("side", "position").collect()]
    assert desc == [
        ("edges", 0, "src", "string"),
        ("edges", 1, "dst", "string"),
        ("edges", 2, "relationship", "string"),
        ("vertices", 0, "id", "string"),
        ("vertices", 1, "name", "string"),
        ("vertices", 2, "age", "int"),
    ]
    first = g.preview("vertices", 2).collect()
    assert [r.id for r in first] == ["a", "b"]


def test_social_triplets(spark):
    g = fx.social_graph(spark)
    t = {(r.src, r.dst): (r.relationship, r.src_name, r.dst_name) for r in g.triplets().collect()}
    assert len(t) == 8
    assert t[("a", "b")] == ("friend", "Alice", "Bob")
    assert t[("e", "d")] == ("friend", "Esther", "David")
