"""Conversation repair of op13 against an exhaustive search."""
import random

import numpy as np
import pytest

from graphloom.llm import structure_repair as sr
from graphloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_audits_match_exhaustive_search():
    rnd = random.Random(5)
    rows, length = [], []
    for n in [0, 0, 1, 1, *(rnd.randrange(9) for _ in range(400)), 60]:
        length.append(n)
        rows.append(tuple((rnd.choice("suax"), rnd.random() < 0.2, rnd.random() < 0.2) for _ in range(n)))
    rows = [tuple((i, g, c and not g) for i, g, c in r) for r in rows]
    codes = [("suax".index(i)) | g * sr._GONE | c * sr._CUT for r in rows for i, g, c in r]
    cost, text = sr.audits(np.array(codes, np.int64), np.array(length, np.int64))
    assert list(zip(cost.tolist(), text)) == [brute.cheapest_edits(r) for r in rows]


@pytest.mark.parametrize("seed", [0, 1])
def test_repair_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", None, "", "tool"], ["a.", "b! ", "é?\n", " x", "", "q.w", None, "\x0b "]
    rows = []
    for c in [*range(-7, 150), None]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t * rnd.choice([1, 1, 2]) if rnd.random() < 0.95 else None, rnd.choice(roles), rnd.choice(texts)))
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", copy int, tie string").repartition(4)
    assert result(sr.repair_conversations(sr.damaged(df))) == sorted(brute.repair(rows), key=str)
    assert sr.repair_conversations(sr.damaged(df.limit(0))).collect() == []


def test_undamaged_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Well."), (3, 5, "system", "Be."), (3, 9, "user", "So?")]
    got = {r.conv_id: r for r in sr.repair_conversations(sr.whole(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert [(got[c].cost, got[c].audit, got[c].gaps) for c in (1, 2, 3)] == [(0, "KK", 0), (2, "D", 0), (2, "RR", 3)]


def test_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}." if t % 7 else "cut") for t in range(1500)]
    assert result(sr.repair_conversations(sr.damaged(spark.createDataFrame(rows, SCHEMA)))) == brute.repair(rows)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op13_structure_repair"](spark, SMALL)) == sorted(brute.repair(rows), key=str)
