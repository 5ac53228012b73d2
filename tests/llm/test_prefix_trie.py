"""The conversation trie of op12 against plain dictionaries."""
import hashlib
import random

import pytest

from graphloom.llm import prefix_trie as pt
from graphloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def made(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-7, 50), None]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "b", "é", None, ""])))
    for c in range(100, 140):  # many equal conversations, some prefixes of others
        rows += [(c, t, "user", "a" if c % 5 != 1 or t < 10 else "z") for t in range(8 + c % 3 * 2)]
    return rows


def result(df):
    return sorted((tuple(r) for r in df.select(*pt.OUT).collect()), key=str)


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("turns_per_range", [30, 1_000_000])
def test_trie_matches_dictionaries(spark, seed, turns_per_range):
    """Small ranges: most nodes reach over several of them."""
    rows = made(seed)
    got = result(pt.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), turns_per_range=turns_per_range))
    assert got == sorted(brute.trie(rows), key=str)


def test_blocks_of_many_ids(spark):
    """What ends at a node is hashed over several blocks and tasks."""
    rows = [(c, 0, "user", "same") for c in range(10_000, 22_000)]
    got = result(pt.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert got == sorted(brute.trie(rows), key=str)


def test_repeated_rows_ties_extra_columns_and_empty(spark):
    rows = [(5, 1, "u", "x"), (5, 1, "u", "x"), (5, 1, "a", "y"), (6, None, None, None), (6, 0, "u", "x"), (None, 0, "u", "x")]
    df = spark.createDataFrame([(*r, "k", "d") for r in rows], SCHEMA + ", turns string, key string")
    assert result(pt.rebuilt_trie(df)) == sorted(brute.trie(rows), key=str)
    assert pt.rebuilt_trie(df.limit(0)).collect() == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    lists = spark.createDataFrame([(3, []), (4, []), (7, ["0" * 47 + "5"])], "conv_id long, turns array<string>")
    got = {r.depth: r for r in pt.prefix_trie(lists).collect()}
    assert (got[0].n_convs, got[0].n_children, got[0].n_leaves, got[0].parent_conv_id) == (3, 1, 1, None)
    assert got[0].ends_sha256 == hashlib.sha256(b"3,4").hexdigest()
    assert (got[1].conv_id, got[1].parent_conv_id, got[1].saved_tokens) == (7, 3, 0)


def test_long_conversation(spark):
    rows = [(c, t, "user", f"{t if t != 1500 else c}") for c in (10, 11) for t in range(2000)]
    got = result(pt.rebuilt_trie(spark.createDataFrame(rows, SCHEMA), turns_per_range=500))
    assert got == sorted(brute.trie(rows), key=str)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op12_prefix_trie"](spark, SMALL)) == sorted(brute.trie(rows), key=str)
