"""Runs that go on after a loss, negative cycles, relaxation tested on the edge."""
import random

import pytest

from graphloom import PropertyGraph, max_reach, sssp, sssp_paths
from graphloom.operators import pregel as engine
from graphloom.plans import cycles, paths
from graphloom.plans.cycles import NegativeCycle


def graph(spark, edges, vertices=()):
    ids = sorted({*vertices, *(x for e in edges for x in e[:2])})
    v = spark.createDataFrame([(i, i * 7 % 11) for i in ids], "id long, value long")
    return PropertyGraph(v, spark.createDataFrame(edges, "src long, dst long, weight long"))


def costs(res):
    return {r.id: r.dist for r in res.vertices.collect()}


def rounds_of(res):
    return [tuple(r)[:5] for r in res.trace.orderBy("superstep").collect()]


EDGES = [(i, i + 1, 2) for i in range(9)] + [(0, 5, 11), (3, 7, 1), (9, 0, 4), (0, 20, 1)]


class Lost(BaseException):
    """The driver goes away."""


def lose_at(monkeypatch, round_):
    real = engine._StateStore.write

    def write(self, df, superstep, *metrics, **how):
        out = real(self, df, superstep, *metrics, **how)
        if superstep == round_:  # the state is written, the manifest is not
            raise Lost
        return out

    monkeypatch.setattr(engine._StateStore, "write", write)


@pytest.mark.parametrize("base_rows", [0, 100_000])
def test_a_lost_run_goes_on_from_its_last_round(spark, monkeypatch, base_rows):
    monkeypatch.setattr(engine, "BASE_ROWS", base_rows)  # deltas, or a base a round
    g = graph(spark, EDGES, range(40, 60))
    clean = sssp(g, [0])
    want, trace = costs(clean), rounds_of(clean)
    clean.release()
    name = f"lost_{base_rows}"
    with monkeypatch.context() as m:
        lose_at(m, 4)
        with pytest.raises(Lost):
            sssp(g, [0], resume=name)
    for table in [t.name for t in spark.catalog.listTables() if name in t.name]:
        spark.sql(f"DROP TABLE {table}")  # the catalog goes with its driver
    first = []
    real = engine._superstep
    monkeypatch.setattr(engine, "_superstep", lambda *a, **k: first.append(a[4]) or real(*a, **k))
    monkeypatch.setattr(engine, "_write_edges", None)  # not built again
    res = sssp(g, [0], resume=name)
    assert first[0] == 4
    assert costs(res) == want and rounds_of(res) == trace
    # a run that has ended is there until it is released
    first.clear()
    again = sssp(g, [0], resume=name)
    assert first == [] and costs(again) == want and rounds_of(again) == trace
    again.release()
    assert not [t.name for t in spark.catalog.listTables() if name in t.name]


def test_resumed_hubs_directions_and_paths(spark, monkeypatch):
    star = [(0, i, i) for i in range(1, 60)] + [(i, i + 1, 1) for i in range(1, 12)]
    g = graph(spark, star)
    want = {r.id: r.value for r in max_reach(g, direction="in").vertices.collect()}
    clean = sssp_paths(g, [0])
    routes = sorted(map(tuple, clean.vertices.collect()))
    monkeypatch.setattr(paths, "CARRY_EDGES", 0)
    with monkeypatch.context() as m:
        lose_at(m, 2)
        with pytest.raises(Lost):
            sssp_paths(g, [0], resume="routes")
    for _ in range(2):
        res = sssp_paths(g, [0], resume="routes")
        assert sorted(map(tuple, res.vertices.collect())) == routes
    res.release()
    program = engine.VertexProgram(send=lambda s: s, merge=engine.F.max, update=lambda s, m: engine.F.greatest(s, m))
    how = dict(state=engine.F.col("value"), direction="in", resume="back")
    with monkeypatch.context() as m:
        lose_at(m, 2)
        with pytest.raises(Lost):
            engine.pregel(g, program, **how)
    res = engine.pregel(g, program, **how)
    assert {r.id: r.state for r in res.vertices.collect()} == want
    res.release()


def test_names_and_errors_of_resumed_runs(spark):
    g = graph(spark, [(0, 1, -1)])
    with pytest.raises(ValueError, match="name of a run"):
        sssp(g, [0], resume="../elsewhere")
    with pytest.raises(ValueError, match="negative edge weight"):
        sssp(g, [0], resume="wrong")
    assert not [t.name for t in spark.catalog.listTables() if "wrong" in t.name]
    res = sssp(graph(spark, EDGES), [0], max_iterations=2, resume="short")
    with pytest.raises(RuntimeError, match="has ended"):
        sssp(graph(spark, EDGES), [0], max_iterations=5, resume="short")
    res.release()


def bellman_ford(edges, ids, source):
    dist = {i: None for i in ids} | {source: 0}
    for _ in ids:
        for s, d, w in edges:
            if dist[s] is not None and (dist[d] is None or dist[s] + w < dist[d]):
                dist[d] = dist[s] + w
    return dist


def test_negative_cycle_ends_a_search_of_many_vertices(spark):
    chain = [(i, i + 1, 1) for i in range(100, 400)]
    edges = [(1, 2, 3), (2, 3, -5), (3, 4, 1), (4, 2, 1), (3, 100, 1), *chain]
    with pytest.raises(NegativeCycle) as got:
        sssp(graph(spark, edges), [1], allow_negative=True)
    # far fewer rounds than the 305 vertices
    assert got.value.vertices == [2, 3, 4] and got.value.total == 3 and got.value.rounds == cycles.CHECK_EVERY
    with pytest.raises(NegativeCycle) as got:
        sssp(graph(spark, [(1, 2, 5), (3, 2, -1)]), [1], allow_negative=True, direction="either")
    assert got.value.vertices == [2, 3]


@pytest.mark.parametrize("search", [sssp, sssp_paths])
def test_signed_weights_without_negative_cycles_are_no_alarm(spark, monkeypatch, search):
    """Weights shifted by vertex potentials: many are negative, many cycles weigh 0."""
    monkeypatch.setattr(cycles, "CHECK_EVERY", 2 if search is sssp else 5)
    rng = random.Random(3)
    ids = range(30)
    height = {i: rng.randint(-40, 40) for i in ids}
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(45)] + [(i, i + 1) for i in range(0, 28, 2)]
    edges = [(a, b, rng.choice([0, 0, 0, 2]) + height[a] - height[b]) for a, b in pairs]
    edges += [(b, a, height[b] - height[a]) for a, b, _ in edges[:12]]
    res = search(graph(spark, edges, ids), [0], allow_negative=True)
    assert costs(res) == bellman_ford(edges, ids, 0)
    res.release()


def test_negative_cycle_among_cycles_of_weight_zero(spark, monkeypatch):
    monkeypatch.setattr(cycles, "CHECK_EVERY", 3)
    zero = [(0, 1, 2), (1, 2, 0), (2, 1, 0), (2, 3, 0), (3, 1, 0)]
    with pytest.raises(NegativeCycle) as got:
        sssp(graph(spark, [*zero, (3, 4, 1), (4, 5, -3), (5, 6, 1), (6, 4, 1)]), [0], allow_negative=True)
    assert got.value.vertices == [4, 5, 6]


@pytest.mark.parametrize("direction", ["out", "in"])
def test_guarded_costs_merge_fewer_messages(spark, direction):
    rng = random.Random(9)
    edges = [(rng.randrange(25), rng.randrange(25), rng.randint(0, 9)) for _ in range(120)] + [(3, 4, None)]
    g = graph(spark, edges)
    plain, guarded = sssp(g, [3], direction=direction), sssp(g, [3], direction=direction, guarded=True)
    assert costs(plain) == costs(guarded)
    sent = [res.trace.agg({"messages": "sum"}).first()[0] for res in (plain, guarded)]
    assert sent[1] < sent[0] / 2
    plain.release(), guarded.release()
