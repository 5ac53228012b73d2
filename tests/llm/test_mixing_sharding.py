import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm.poisson_mixing import MAX_RATE, SEED, mix_sources, source_rates
from graphloom.llm import sharding
from graphloom.llm.sharding import communication_matrix, hypergeometric, shard_rows, shard_sizes
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, position string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 99) for i, t, s in rows], SCHEMA)


def test_copies_follow_inverted_poisson_counts(spark):
    rows = [(i, f"t{i}", "big" if i < 300 else "small") for i in range(306)] + [(None, None, None), (5, "again", "big")]
    rows += [(None, "same", "big")] * 40 + [(None, None, "big")] * 9 + [(7, "t7", "big")] * 5 + [(8, None, None), (8, "", None)]
    docs = frame(spark, rows).drop("shard")
    rates = {r[0]: (r[1], r[2]) for r in source_rates(docs).collect()}
    out = mix_sources(docs).collect()
    got, want = Counter((r.doc_id, r.text, r.source) for r in out), Counter()
    for (i, t, s), name in zip(rows, brute.mixing_names(rows)):
        rate, strata = rates["-" if s is None else f"={s}"]
        assert rate <= MAX_RATE
        want[i, t, s] += sum(brute.poisson_count(SEED, name, k, rate) for k in range(1, strata + 1))
    assert got == +want
    assert sorted(r.position for r in out) == list(range(len(out)))
    assert mix_sources(docs).collect() != [] and mix_sources(docs.limit(0)).collect() == []


def test_rows_without_an_id_keep_their_share(spark):
    """A source keeps its rate of rows whether they have ids or not, equal rows and
    rows that differ in a further column only included."""
    rows = [(i, f"t{i}", s) for i in range(300) for s in ("a", "b")] + [(None, "same", "a"), (None, "same", "b")] * 300
    docs = frame(spark, rows).withColumn("shard", F.monotonically_increasing_id() % 3)
    out = mix_sources(docs, weights={"a": 0.25, "b": 0.75}, budget=1200)
    n = {(r.source, r.unclear): r["count"] for r in out.groupBy("source", F.expr("text = 'same'").alias("unclear")).count().collect()}
    for source, want in (("a", 150), ("b", 450)):
        assert abs(n[source, True] - want) < 5 * want**0.5
        assert abs(n[source, False] - want) < 5 * want**0.5


def test_mixing_agrees_with_its_oracle_on_unclear_ids(spark):
    import duckdb

    from graphloom.llm.oracles import ORACLES

    rows = [(i % 40 if i % 3 else None, "x" if i % 4 else None, None, "s" if i % 5 else "r", i % 2) for i in range(200)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    got = mix_sources(spark.createDataFrame(rows, schema)).collect()
    documents = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()))], schema.replace(" long", "").replace(" string", "").split(", "))
    db = duckdb.connect()
    db.register("documents", documents)
    want = db.execute(ORACLES["op2_mix_sources"])
    names = [d[0] for d in want.description]
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == sorted(want.fetchall(), key=str)


def test_weights_and_large_rates(spark):
    rows = [(i, "a", "big") for i in range(400)] + [(1000, "b", "rare")]
    docs = frame(spark, rows)
    out = mix_sources(docs, weights={"rare": 0.5, "big": 0.5}, budget=2000)
    n = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    assert abs(n["rare"] - 1000) < 150 and abs(n["big"] - 1000) < 150
    assert {r[0] for r in mix_sources(docs, weights={"big": 1.0}).select("source").distinct().collect()} == {"big"}
    again = [tuple(r) for r in mix_sources(docs).orderBy("position").collect()]
    assert again == [tuple(r) for r in mix_sources(docs.repartition(7)).orderBy("position").collect()]


def test_hypergeometric_law():
    rng = random.Random(4)
    good, bad, draws, n = 7, 12, 9, 40_000
    seen = [0] * 10
    for _ in range(n):
        seen[hypergeometric(rng, good, bad, draws)] += 1
    for k in range(10):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) if k <= good else 0
        assert abs(seen[k] / n - p) < 0.012
    assert hypergeometric(rng, 0, 5, 3) == 0 and hypergeometric(rng, 5, 0, 3) == 3 and hypergeometric(rng, 4, 4, 0) == 0
    big = hypergeometric(rng, 10**11, 10**11, 10**10)
    assert abs(big - 5 * 10**9) < 10**6


def test_mode_of_large_populations():
    # against exact integers, and a total of 1 where integers are too slow
    for k, n, draws, good in ((3, 19, 9, 7), (0, 9, 4, 5), (40, 900, 300, 120), (7, 50, 7, 20)):
        want = math.comb(good, k) * math.comb(n - good, draws - k) / math.comb(n, draws)
        p = draws / n
        got = sharding._log_binomial(k, good, p) + sharding._log_binomial(draws - k, n - good, p) - sharding._log_binomial(draws, n, p)
        assert abs(math.exp(got) / want - 1) < 1e-12
    n, good, draws = 10**13, 10**13 // 24, 10**9
    p = draws / n
    mode = (draws + 1) * (good + 1) // (n + 2)
    top = math.exp(sharding._log_binomial(mode, good, p) + sharding._log_binomial(draws - mode, n - good, p) - sharding._log_binomial(draws, n, p))
    total = term = top
    for k in range(mode, mode + 60_000):  # ten standard deviations to either side
        term *= (good - k) / (k + 1) * (draws - k) / (n - good - draws + k + 1)
        total += term
    term = top
    for k in range(mode, mode - 60_000, -1):
        term *= k / (good - k + 1) * (n - good - draws + k) / (draws - k + 1)
        total += term
    assert abs(total - 1) < 1e-9


def test_many_partitions_share_blocks(spark, monkeypatch):
    assert sharding.merged_blocks(800_000, 24) * (sharding.MATRIX_CELLS // 24) >= 800_000
    monkeypatch.setattr(sharding, "MATRIX_CELLS", 24 * 4)
    drawn = []
    matrix = sharding.communication_matrix
    monkeypatch.setattr(sharding, "communication_matrix", lambda blocks, sizes, seed: drawn.append(blocks) or matrix(blocks, sizes, seed))
    docs = spark.range(0, 2_500, numPartitions=19).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = shard_rows(docs).collect()
    assert len(drawn[0]) <= 4 and sorted(r.doc_id for r in out) == list(range(2_500))
    for shard in range(24):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (104, 105)


def test_matrix_has_exact_margins():
    blocks = {3: 17, 5: 0, 9: 1000, 11: 2}
    sizes = shard_sizes(1019, 24)
    assert max(sizes) - min(sizes) == 1
    m = communication_matrix(blocks, sizes, 1)
    assert {b: sum(r) for b, r in m.items()} == blocks
    assert [sum(c) for c in zip(*m.values())] == sizes


@pytest.mark.parametrize("rows", [0, 1, 23, 1000])
def test_shards_are_exact_and_slots_gapless(spark, rows):
    docs = frame(spark, [(i % 50 if i % 7 else None, None if i % 5 == 0 else "same", "s") for i in range(rows)]).repartition(5)
    out = shard_rows(docs).collect()
    assert len(out) == rows
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shard_is_uniform(spark):
    docs = spark.range(0, 24_000, numPartitions=6).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = shard_rows(docs)
    # rows of one input block spread over shards and over slots
    first = out.where("doc_id < 4000").groupBy("shard").count().collect()
    assert len(first) == 24 and all(110 < r[1] < 225 for r in first)
    mean = out.where("doc_id < 4000").agg(F.avg("slot")).first()[0]
    assert abs(mean - 499.5) < 25
