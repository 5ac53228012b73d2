"""Log-structured state, directions, many messages, prepared graphs, paths from predecessors."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom import PreparedGraph, PropertyGraph, VertexProgram, max_reach, pregel, sssp, sssp_paths, strength, walk_counts
from graphloom.functions.programs import relax_min
from graphloom.operators import pregel as engine
from graphloom.plans import paths


def graph(spark, edges, vertices=()):
    ids = sorted({*vertices, *(x for e in edges for x in e[:2])})
    v = spark.createDataFrame([(i, i * 7 % 11) for i in ids], "id long, value long")
    return PropertyGraph(v, spark.createDataFrame(edges, "src long, dst long, weight long"))


def best_paths(edges, ids, sources):
    """Least (cost, hops, path) of every vertex, by rounds over all edges."""
    best = {i: (0, 0, (i,)) if i in sources else None for i in ids}
    while True:
        after = dict(best)
        for s, d, w in edges:
            if best[s] is not None:
                walk = (best[s][0] + w, best[s][1] + 1, (*best[s][2], d))
                if after[d] is None or walk < after[d]:
                    after[d] = walk
        if after == best:
            return best
        best = after


def path_rows(res):
    return {r.id: None if r.dist is None else (r.dist, r.hops, tuple(r.path)) for r in res.vertices.collect()}


@pytest.mark.parametrize("sort_rows", [0, 1000])
def test_paths_from_predecessors_with_many_ties(spark, monkeypatch, sort_rows):
    """A layered graph in which most vertices have several cheapest walks."""
    monkeypatch.setattr(paths, "CARRY_EDGES", 0)
    monkeypatch.setattr(paths, "SORT_ROWS", sort_rows)
    rng = random.Random(sort_rows)
    layers = [rng.sample(range(1, 90), 6) for _ in range(5)]
    edges = [(a, b, rng.choice([1, 1, 2])) for x, y in zip(layers, layers[1:]) for a in x for b in y if rng.random() < 0.7]
    edges += [(a, b, 0) for a, b in zip(layers[1], layers[1][1:])] + edges[:3]  # zero weights, parallel edges
    sources = layers[0][:3]
    g = graph(spark, edges, [200])
    res = sssp_paths(g, sources)
    ids = {r.id for r in g.vertices.collect()}
    assert path_rows(res) == best_paths(edges, ids, sources)
    res.release()
    assert not res._store


def test_small_graphs_carry_paths_and_large_ones_do_not(spark, monkeypatch):
    edges = [(i, i + 1, 1) for i in range(9)] + [(0, 5, 5), (5, 0, 1)]
    kinds = []
    real = engine._superstep

    def spy(frontier, *args, **kwargs):
        kinds.append(frontier.schema["state"].dataType.simpleString())
        return real(frontier, *args, **kwargs)

    monkeypatch.setattr(engine, "_superstep", spy)
    want = best_paths(edges, range(10), [0])
    assert path_rows(sssp_paths(graph(spark, edges), [0])) == want
    assert all(k.startswith("struct") for k in kinds)
    kinds.clear()
    monkeypatch.setattr(paths, "CARRY_EDGES", 0)
    assert path_rows(sssp_paths(graph(spark, edges), [0])) == want
    assert set(kinds) == {"bigint"}  # states and messages of fixed width


def test_merge_without_paths_is_a_hash_aggregate(spark, monkeypatch, capsys):
    monkeypatch.setattr(paths, "CARRY_EDGES", 0)
    plans = []
    real = engine._superstep

    def spy(*args, **kwargs):
        out = real(*args, **kwargs)
        capsys.readouterr()
        out.explain()
        plans.append(capsys.readouterr().out)
        return out

    monkeypatch.setattr(engine, "_superstep", spy)
    sssp_paths(graph(spark, [(0, 1, 2), (1, 2, 2)]), [0]).release()
    assert all("HashAggregate" in p and "SortAggregate" not in p for p in plans)


def rows_written(monkeypatch):
    """Rows in every state table, counted from its files as it is written."""
    seen = []
    real = engine._StateStore.write

    def spy(self, df, superstep, *metrics, **kwargs):
        table, row = real(self, df, superstep, *metrics, **kwargs)
        seen.append(self.spark.read.schema(table.schema).parquet(self.path(self.step(superstep))).count())
        return table, row

    monkeypatch.setattr(engine._StateStore, "write", spy)
    return seen


def test_late_rounds_write_what_changed(spark, monkeypatch):
    """A chain behind a star: after the first rounds one vertex changes a round."""
    monkeypatch.setattr(engine, "BASE_ROWS", 0)
    seen = rows_written(monkeypatch)
    edges = [(0, i, 1) for i in range(100, 700)] + [(i, i + 1, 1) for i in range(14)]
    res = sssp(graph(spark, edges), [0])
    assert {r.id: r.dist for r in res.vertices.collect()} == {0: 0, **{i: 1 for i in range(100, 700)}, **{i: i for i in range(1, 15)}}
    changed = [r.changed for r in res.trace.orderBy("superstep").collect()]
    assert seen[:3] == [615, 601, 615]  # the start, what changed, and after so many active vertices a new base
    # then a round writes what changed, and at times smaller deltas again
    assert len(seen) > 12 and all(n <= 8 for n in seen[3:]) and sum(seen[3:]) < 4 * sum(changed[2:])
    assert sum(n == c for n, c in zip(seen[3:], changed[2:])) >= len(changed) // 3


@pytest.mark.parametrize("base_rows", [0, 1000])
def test_every_state_layout_gives_the_same_costs(spark, monkeypatch, base_rows):
    monkeypatch.setattr(engine, "BASE_ROWS", base_rows)
    monkeypatch.setattr(engine, "BASE_SHARE", 1)
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60), rng.randrange(1, 30)) for _ in range(150)] + [(i, i + 1, 40) for i in range(59)]
    want = {i: b and b[0] for i, b in best_paths(edges, range(60), [0]).items()}
    res = sssp(graph(spark, edges), [0])
    assert {r.id: r.dist for r in res.vertices.collect()} == want
    v = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "id long")
    kept = [e for e in edges if e[0] % 2 == 0 and e[1] % 2 == 0]  # odd ends are no vertices
    some = pregel(
        PropertyGraph(v, spark.createDataFrame(edges, "src long, dst long, weight long")), relax_min("weight"),
        state=F.when(F.col("id") == 0, F.lit(0).cast("long")), fill_missing=False,
    )
    want = {i: b and b[0] for i, b in best_paths(kept, range(0, 60, 2), [0]).items()}
    assert {r.id: r.state for r in some.vertices.collect()} == want


def reachable(edges, ids):
    out = {i: {i} for i in ids}
    while True:
        size = sum(map(len, out.values()))
        for s, d in edges:
            out[s] |= out[d]
        if size == sum(map(len, out.values())):
            return out


EDGES = [(1, 2, 3), (2, 3, 4), (3, 1, 5), (4, 3, 1), (5, 6, 2), (6, 6, 9), (7, 5, 1), (2, 3, 1)]


@pytest.mark.parametrize("direction", ["out", "in", "either"])
@pytest.mark.parametrize("guarded", [False, True])
def test_directions(spark, direction, guarded):
    ids = range(1, 9)
    pairs = [(s, d) for s, d, _ in EDGES]
    used = {"in": pairs, "out": [(d, s) for s, d in pairs], "either": pairs + [(d, s) for s, d in pairs]}[direction]
    want = {i: max(j * 7 % 11 for j in r) for i, r in reachable(used, ids).items()}
    res = max_reach(graph(spark, EDGES, [8]), direction=direction, guarded=guarded)
    assert {r.id: r.value for r in res.vertices.collect()} == want


def test_direction_in_with_hubs(spark):
    """A vertex with most in-edges is read by file split there, too."""
    edges = [(i, 0, i) for i in range(1, 60)] + [(0, 99, 1)]
    res = sssp(graph(spark, edges), [99], direction="in")
    assert {r.id: r.dist for r in res.vertices.collect()} == {99: 0, 0: 1, **{i: i + 1 for i in range(1, 60)}}
    with pytest.raises(ValueError):
        max_reach(graph(spark, edges), direction="sideways")


def test_messages_to_both_ends(spark):
    want = Counter()
    for s, d, w in EDGES:
        want[s] += w
        want[d] += w
    res = strength(graph(spark, EDGES, [8]))
    assert {r.id: r.strength for r in res.vertices.collect()} == {i: want[i] for i in range(1, 9)}
    assert [tuple(r)[:5] for r in res.trace.collect()] == [(1, 8, 16, 7, 7)]


def test_both_active_ends_use_an_edge_once(spark):
    program = VertexProgram(
        send=None, merge=F.sum, update=lambda state, msg: state + msg, active_on="received",
        send_all=lambda src, dst: engine.messages(to_src=F.lit(1).cast("long"), to_dst=F.lit(1).cast("long")),
    )
    res = pregel(graph(spark, EDGES), program, state=F.lit(0).cast("long"), max_iterations=1, direction="either")
    degree = Counter(x for s, d, _ in EDGES for x in (s, d))
    assert {r.id: r.state for r in res.vertices.collect()} == dict(degree)


def test_walk_counts_add_up(spark):
    """A vertex that received sends again, although its total may be anything."""
    now, total = Counter({1: 1, 7: 1}), Counter()
    for _ in range(4):
        now = sum((Counter({d: now[s]}) for s, d, _ in EDGES if now[s]), Counter())
        total += now
    res = walk_counts(graph(spark, EDGES, [8]), [1, 7], 4)
    assert {r.id: r.walks for r in res.vertices.collect()} == {i: total[i] for i in range(1, 9)}


def test_prepared_graph_writes_its_edges_once(spark, monkeypatch):
    written = []
    real = engine._StateStore.write_table

    def spy(self, df, key, *metrics, **kwargs):
        written.append(key)
        return real(self, df, key, *metrics, **kwargs)

    monkeypatch.setattr(engine._StateStore, "write_table", spy)
    prepared = PreparedGraph(graph(spark, EDGES, [8]), edge_min_columns=("weight",))
    there = sssp(prepared, [1]).vertices
    back = sssp(prepared, [1], direction="in").vertices
    again = sssp_paths(prepared, F.col("value") == 3)
    assert written.count("edges") == 1 and written.count("edges_in") == 1
    assert {r.id: r.dist for r in there.collect()} == {i: b and b[0] for i, b in best_paths(EDGES, range(1, 9), [1]).items()}
    turned = [(d, s, w) for s, d, w in EDGES]
    assert {r.id: r.dist for r in back.collect()} == {i: b and b[0] for i, b in best_paths(turned, range(1, 9), [1]).items()}
    assert path_rows(again) == best_paths(EDGES, range(1, 9), [i for i in range(1, 9) if i * 7 % 11 == 3])
    monkeypatch.setattr(paths, "CARRY_EDGES", 0)
    assert path_rows(sssp_paths(prepared, [7])) == best_paths(EDGES, range(1, 9), [7])
    assert there.count() == 8  # results outlive the handle
    prepared.release()
    assert there.count() == 8
    with pytest.raises(ValueError):
        PreparedGraph(graph(spark, [(1, 2, -1)]), edge_min_columns=()) and sssp(PreparedGraph(graph(spark, EDGES)), [1])
