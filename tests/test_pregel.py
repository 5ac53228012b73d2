"""The Pregel loop itself: fused supersteps, cleanup, checkpoint folder."""
from pyspark.sql import functions as F

from graphloom import PropertyGraph, pregel
from graphloom.functions.programs import path_start, relax_path
from graphloom.operators.pregel import MAX_DELTAS
from graphloom.session import checkpoint_dir


def chain_graph(spark):
    edges = [(i, i + 1, 1 + i % 3) for i in range(12)] + [(0, 6, 20), (3, 9, 2), (9, 2, 1)]
    v = spark.createDataFrame([(i,) for i in range(13)], "id long")
    e = spark.createDataFrame(edges, "src long, dst long, weight long")
    return PropertyGraph(v, e)


def run(spark, fuse):
    g = chain_graph(spark)
    res = pregel(
        g,
        relax_path("weight"),
        state=F.when(F.col("id") == 0, path_start(F.col("id"))),
        fuse=fuse,
    )
    rows = sorted((r.id, r.state.dist if r.state else None, tuple(r.state.path) if r.state else None)
                  for r in res.vertices.collect())
    trace = [tuple(r)[:5] for r in res.trace.orderBy("superstep").collect()]
    return res, rows, trace


def test_fused_supersteps_change_nothing(spark):
    _, rows1, trace1 = run(spark, 1)
    for fuse in (2, 3):
        res, rows, trace = run(spark, fuse)
        assert rows == rows1
        assert trace == trace1
        assert res.rounds == len(trace1) and res.converged


def test_release_drops_tables(spark):
    res, _, _ = run(spark, 2)
    prefix = f"graphloom_pregel_{res._store.tag}_"
    mine = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    assert 1 <= len(mine) <= 1 + MAX_DELTAS  # the last state is all that stays: a base and its deltas
    assert not any("edges" in name for name in mine)
    res.release()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]


def test_checkpoint_dir_comes_from_session(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_without_fill_messages_to_unknown_ids_are_dropped(spark):
    from graphloom.functions.programs import relax_min

    v = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    e = spark.createDataFrame([(1, 2, 4), (1, 9, 1), (9, 3, 1), (2, 3, 5)], "src long, dst long, weight long")
    res = pregel(
        PropertyGraph(v, e),
        relax_min("weight"),
        state=F.when(F.col("id") == 1, F.lit(0).cast("long")),
        fill_missing=False,
        edge_min_columns=("weight",),
    )
    # 9 is no vertex: its message is dropped and the path 1 -> 9 -> 3 never forms
    assert dict(res.vertices.collect()) == {1: 0, 2: 4, 3: 9}
    assert res.edge_stats["edges"] == 4 and res.edge_stats["min_weight"] == 1
    filled = pregel(
        PropertyGraph(v, e),
        relax_min("weight"),
        state=F.when(F.col("id") == 1, F.lit(0).cast("long")),
        edge_min_columns=("weight",),
    )
    assert dict(filled.vertices.collect()) == {1: 0, 2: 4, 3: 2, 9: 1}
    assert filled.edge_stats["edges"] == 4 and filled.edge_stats["max_out_degree"] == 2


def shipped_plan(spark, capsys, monkeypatch, edges, parts=4, **options):
    """Plan of the first superstep exactly as the loop runs it."""
    from graphloom.functions.programs import relax_min
    from graphloom.operators import pregel as module

    seen = []
    real = module._superstep

    def spy(*args, **kwargs):
        out = real(*args, **kwargs)
        if not seen:
            capsys.readouterr()
            out.explain()
            seen.append(capsys.readouterr().out)
        return out

    monkeypatch.setattr(module, "_superstep", spy)
    v = spark.createDataFrame([(i,) for i in range(40)], "id long")
    g = PropertyGraph(v, spark.createDataFrame(edges, "src long, dst long, weight long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = F.when(F.col("id") == 0, F.lit(0).cast("long"))
        res = module.pregel(g, relax_min("weight"), state=start, partitions=parts, **options)
        rows = dict(res.vertices.collect())
        res.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return seen[0], rows


def test_superstep_moves_only_messages(spark, capsys, monkeypatch):
    """State and edges are co-bucketed: the only exchange of a superstep is the
    message shuffle, and no join is forced into memory."""
    plan, rows = shipped_plan(spark, capsys, monkeypatch, [(i, i + 1, 1) for i in range(39)])
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(exchanges) == 1 and "hashpartitioning(id" in exchanges[0], plan
    assert "partial_min" in plan and "ShuffledHashJoin" not in plan and "SortMergeJoin" in plan
    assert rows == {i: i for i in range(40)}


def test_superstep_with_hubs(spark, capsys, monkeypatch):
    edges = [(0, i, i) for i in range(1, 40)] + [(i, i + 1, 1) for i in range(1, 20)]
    plan, rows = shipped_plan(spark, capsys, monkeypatch, edges)
    # the hub's edges meet one broadcast frontier row; state and other edges stay
    exchanges = [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]
    assert len(exchanges) == 1 and plan.count("BroadcastExchange") == 1, plan
    assert rows == {0: 0, **{i: i for i in range(1, 40)}}


def test_small_frontier_is_pushed_into_the_edge_scan(spark, capsys, monkeypatch):
    from graphloom.operators import pregel as module

    monkeypatch.setattr(module, "PUSH_EDGES", 1)
    plan, rows = shipped_plan(spark, capsys, monkeypatch, [(i, i + 1, 1) for i in range(39)])
    assert "SelectedBucketsCount: 1 out of 4" in plan and "EqualTo(src,0)" in plan, plan
    assert rows == {i: i for i in range(40)}


def test_failure_leaves_no_tables(spark):
    import pytest

    from graphloom.operators.pregel import _OPEN
    from graphloom.session import release_all

    release_all(spark)
    before = {t.name for t in spark.catalog.listTables()}

    def fail(stats, vertices):
        raise ValueError("no")

    with pytest.raises(ValueError):
        pregel(chain_graph(spark), relax_path("weight"), state=F.lit(None), validate=fail)
    with pytest.raises(Exception):
        pregel(chain_graph(spark), relax_path("missing"), state=F.when(F.col("id") == 0, path_start(F.col("id"))))
    assert {t.name for t in spark.catalog.listTables()} == before and not _OPEN


def test_triplet_send_reads_both_ends(spark):
    from graphloom import max_reach

    v = spark.createDataFrame([(1, 9), (2, 1), (3, 6), (4, None), (5, 3)], "id long, value long")
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 1)], "src long, dst long")
    plain, guarded = max_reach(PropertyGraph(v, e)), max_reach(PropertyGraph(v, e), guarded=True)
    assert dict(guarded.vertices.collect()) == dict(plain.vertices.collect()) == {1: 9, 2: 9, 3: 9, 4: 9, 5: 3}
    sent = [r.trace.agg(F.sum("messages")).first()[0] for r in (guarded, plain)]
    assert sent[0] < sent[1]


def test_vertex_table_of_one_number_needs_no_sort_aggregate(spark, capsys):
    from graphloom.operators.pregel import _vertex_table

    v = spark.createDataFrame([(1, 9), (1, 3), (2, None)], "id long, value long")
    e = spark.createDataFrame([(1, 7, 2), (1, 2, None)], "src long, dst long, weight long")
    t = _vertex_table(v, e, ("weight",))
    capsys.readouterr()
    t.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    assert {r.id: (r.value, r._deg, r._min_weight, r._nulls_weight) for r in t.collect()} == {
        1: (3, 2, 2, 1), 2: (None, 0, None, 0), 7: (None, 0, None, 0),
    }
