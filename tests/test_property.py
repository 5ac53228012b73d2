"""Random graphs against plain-Python shortest paths."""
import heapq

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from graphloom import PropertyGraph, max_reach, sssp_paths


def dijkstra(n, edges, src):
    adj = {}
    for s, d, w in edges:
        adj.setdefault(s, []).append((d, w))
    best = {src: 0}
    heap = [(0, src)]
    while heap:
        c, u = heapq.heappop(heap)
        if c > best.get(u, 1 << 60):
            continue
        for d, w in adj.get(u, []):
            if c + w < best.get(d, 1 << 60):
                best[d] = c + w
                heapq.heappush(heap, (c + w, d))
    return best


graphs = st.integers(min_value=2, max_value=9).flatmap(
    lambda n: st.tuples(
        st.just(n),
        st.lists(
            st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 6)),
            max_size=25,
        ),
    )
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(graphs)
def test_paths_are_shortest_and_valid(spark, g):
    n, edges = g
    v = spark.createDataFrame([(i, i * 3 % 7) for i in range(n)], "id long, value long")
    e = spark.createDataFrame(edges, "src long, dst long, weight long")
    graph = PropertyGraph(v, e)
    res = sssp_paths(graph, [0])
    best = dijkstra(n, edges, 0)
    weight = {}
    for s, d, w in edges:
        weight[(s, d)] = min(w, weight.get((s, d), 1 << 60))
    for r in res.vertices.collect():
        assert r.dist == best.get(r.id)
        if r.dist is not None:
            path = list(r.path)
            assert path[0] == 0 and path[-1] == r.id and r.hops == len(path) - 1
            assert sum(weight[(a, b)] for a, b in zip(path, path[1:])) == r.dist
    # max_reach: the largest value among the vertices that reach each vertex
    reach = {i: {i} for i in range(n)}
    changed = True
    while changed:
        changed = False
        for s, d, _ in edges:
            new = reach[s] - reach[d]
            if new:
                reach[d] |= new
                changed = True
    got = dict(max_reach(graph).vertices.collect())
    assert got == {i: max(j * 3 % 7 for j in reach[i]) for i in range(n)}
