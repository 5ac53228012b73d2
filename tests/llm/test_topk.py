import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import norm_topk
from graphloom.llm.norm_topk import quantized, top_k


def brute(rows, k=5):
    vec = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in vec:
        if i % 10 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vec if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -p) for r, (p, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("spread, block", [(0.0, 8192), (2.0, 8192), (0.0, 7), (2.0, 7)])
def test_matches_brute_force(spark, monkeypatch, spread, block):
    monkeypatch.setattr(norm_topk, "BUCKET", 40)
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", block)
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(600, 8))
    unit[300:450] = unit[300] + 0.05 * rng.normal(size=(150, 8))  # near the same direction: high cosines
    unit *= np.exp(spread * rng.normal(size=(600, 1)))
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(unit)]
    rows += [(700 + i, rows[300][1]) for i in range(40)]  # ties
    rows += [(800, None), (810, [None] * 8), (820, [float("nan")] * 8), (830, [float("inf")] * 8), (840, [0.0] * 8), (850, []), (860, [1.0, 2.0]), (861, [3.0, -1.0])]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    vectors = docs.select("vec_id", quantized(F.col("embedding")).alias("v"))
    got = sorted(tuple(r) for r in top_k(vectors, F.col("vec_id") % 10 == 0, part_rows=120).collect())
    assert got == brute(rows)


def test_empty_few_and_large(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, v array<long>")
    asked = F.col("vec_id") % 10 == 0
    assert top_k(make([]), asked).collect() == []
    assert top_k(make([(10, [1, 2])]), asked).collect() == []
    few = top_k(make([(10, [1, 2]), (11, [2**31, 5]), (11, [3, 3]), (None, [9, 9])]), asked).collect()
    assert [tuple(r) for r in few] == [(10, 1, 11, 2**31 + 10), (10, 2, 11, 9)]
    big = top_k(make([(10, [2**40, 1]), (11, [2**40, 1]), (12, [-(2**40), 0])]), asked).collect()
    assert [r.score for r in big] == [2**63 - 1, -(2**63)]


def test_queries_of_one_part_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 20)
    dealt = []
    real = norm_topk.map_arrow

    def seen(df, task, schema):
        dealt.append(df.where("query").groupBy("part").count().collect())
        return real(df, task, schema)

    monkeypatch.setattr(norm_topk, "map_arrow", seen)
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-99, 99, 4)]) for i in range(400)]
    out = top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 2 == 0, part_rows=100)
    assert out.count() == 200 * 5
    for counts in dealt:  # 200 queries in 10 blocks: no (part, block) holds many of them
        assert len(counts) >= 10 and max(r[1] for r in counts) <= 45
