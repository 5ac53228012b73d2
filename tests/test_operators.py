"""Skew-proof operators against brute force on small inputs."""
import random

from pyspark.sql import functions as F

from graphloom.operators.joins import lookup_join, profile_keys
from graphloom.operators.sequence import successor_pairs
from graphloom.operators.topk import top_k_per_group


def test_successor_pairs_match_per_group_lead(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        g = 0 if i % 3 else rnd.randint(1, 5)  # group 0 holds two thirds of the rows
        rows.append((g, rnd.randint(0, 50), i, rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "g long, t long, k long, u long")
    got = sorted(tuple(r) for r in successor_pairs(df, "g", ["t", "k"], ["u", "k"], slice_key=F.col("t"), slices=5).collect())
    expect = []
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for g, rs in by.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        for a, b in zip(rs, rs[1:]):
            expect.append((g, a[3], a[2], b[3], b[2]))
    assert got == sorted(expect)


def test_top_k_per_group(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 3) if i % 2 else 0, i, rnd.randint(0, 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, d long, w long")
    got = sorted(tuple(r) for r in top_k_per_group(df, "g", [F.col("w").desc(), F.col("d")], 3, buckets=5).collect())
    expect = []
    for g in {r[0] for r in rows}:
        grp = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:3]
        expect += grp
    assert got == sorted(expect)


def test_lookup_join_with_hot_key(spark):
    fact = spark.createDataFrame([(1 if i % 2 else i % 10, i) for i in range(500)], "k long, x long")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(10)], "dk long, name string")
    prof = profile_keys(fact, "k", partitions=8)
    assert prof.hot == [1]
    got = sorted(tuple(r) for r in lookup_join(fact, dim, "k", "dk", profile=prof).collect())
    expect = sorted(tuple(r) for r in fact.join(dim, fact.k == dim.dk).select("k", "x", "name").collect())
    assert got == expect


def test_lookup_join_over_threshold_splits_hot_keys(spark):
    # the dimension does not fit the (tiny) threshold: the fact's hot key is
    # found and joined through a broadcast of its single dimension row
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        fact = spark.createDataFrame([(7 if i % 3 else i % 50, i) for i in range(900)], "k long, x long")
        dim = spark.createDataFrame([(k, f"name-{k}") for k in range(50)], "dk long, name string")
        got = sorted(tuple(r) for r in lookup_join(fact, dim, "k", "dk", how="left").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    expect = sorted((k, x, f"name-{k}") for k, x in [(7 if i % 3 else i % 50, i) for i in range(900)])
    assert got == expect


def test_labels_without_broadcast(spark, capsys):
    from graphloom.plans.report import labelled_costs

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # one source: every reached row shares the label key
        costs = spark.createDataFrame([(i, i - 1, 1) for i in range(1, 900)] + [(900, None, 1)], "id long, dist long, source long")
        labels = spark.createDataFrame([(i, f"L{i}") for i in range(1, 901)], "id long, label string")
        df = labelled_costs(costs, labels)
        capsys.readouterr()
        df.explain()
        plan = capsys.readouterr().out
        got = {r.id: r.line for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got[1] == "Minimum cost to get from L1 to L1 is 0" and got[5] == "Minimum cost to get from L1 to L5 is 4"
    assert got[900] is None and len(got) == 900
    assert "BroadcastHashJoin" in plan  # the hot source is split off to its one label row


def test_size_bound_none_for_nested_columns_falls_back_to_profile(spark):
    from graphloom.operators.joins import size_bounds

    nested = spark.createDataFrame([(1, [1, 2])], "dk long, tags array<long>")
    flat = spark.createDataFrame([(1, "ab")], "dk long, name string")
    assert size_bounds([nested, flat])[0] is None
    assert size_bounds([nested, flat])[1] == 1 * ((8 + 8) + 8 + 2)
    fact = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "k long, x long")
    got = sorted((r.k, r.x, tuple(r.tags) if r.tags else None) for r in lookup_join(fact, nested, "k", "dk", how="left").collect())
    assert got == [(1, 10, (1, 2)), (1, 11, (1, 2)), (2, 12, None)]


def test_successor_pairs_split_one_hot_time(spark):
    """All rows at one key value are cut along the tie key."""
    from graphloom.operators.sequence import _even_slices, successor_pairs

    rows = [(1, 100, i, i % 11) for i in range(3000)] + [(1, 100 + i, 5000 + i, 3) for i in range(1, 500)] + [(2, 100, 9000, 1)]
    df = spark.createDataFrame(rows, "g long, ts long, id long, user long").repartition(5)
    sliced = _even_slices(df.select(F.col("ts").cast("double").alias("_key"), F.col("id").cast("double").alias("_tie")), 16)
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] < 1000
    got = successor_pairs(df, "g", ["ts", "id"], ["id", "user"], F.col("ts"), tie_key=F.col("id"), slices=16).collect()
    order = sorted((g, ts, i, u) for g, ts, i, u in rows)
    want = {(a[2], b[2], a[3], b[3]) for a, b in zip(order, order[1:]) if a[0] == b[0]}
    assert {(r.cur_id, r.next_id, r.cur_user, r.next_user) for r in got} == want and len(got) == len(want)
