"""Golay keys, links and groups of op11 against all pairs."""
import collections

import numpy as np
import pytest
import xxhash

from graphloom.llm import golay_simhash as g
from graphloom.llm.components import connected_components
from graphloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


def test_every_word_is_within_three_bits_of_its_codeword():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 50_000).astype(np.uint32)
    index = g.nearest_codeword(w)
    word = index << np.uint32(11)
    code = word | g._tables()[0][index]  # a codeword: its remainder is its lower part
    assert int(np.bitwise_count(code ^ w).max()) <= 3
    assert len(np.unique(index)) == 4096


@pytest.mark.parametrize("errors", [0, 1, 2])
def test_words_with_few_errors_share_an_index(errors):
    rng = np.random.default_rng(errors)
    a = rng.integers(0, 1 << 22, 5_000).astype(np.uint32)
    b = a.copy()
    for _ in range(errors):
        b ^= (1 << rng.integers(0, 22, len(b))).astype(np.uint32)
    sets = []
    for w in (a, b):
        row, index = g.near_indices(w, 22)
        s = collections.defaultdict(set)
        for r, i in zip(row.tolist(), index.tolist()):
            s[r].add(i)
        assert max(map(len, s.values())) <= 6
        sets.append(s)
    assert all(sets[0][r] & sets[1][r] for r in range(len(a)))


@pytest.mark.parametrize("key_rows", [2, 8, 512])
def test_links_connect_what_all_pairs_connect(spark, key_rows):
    """Dense neighbourhoods; with a small ``key_rows`` they are settled without pairs."""
    rng = np.random.default_rng(3)
    prints = set()
    for base in rng.integers(0, 1 << 63, 12).tolist():
        for _ in range(50):
            x = base
            for bit in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    want = collections.defaultdict(set)
    for x, r in zip(prints, brute.close_groups(prints)):
        want[r].add(x)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    got = collections.defaultdict(set)
    for row in connected_components(g.links(df, key_rows=key_rows)).collect():
        got[row.root].add(row.node % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_hash_is_xxh64():
    words = [b"one", b"two", b"three"]
    digests, count = g._digests(words, np.arange(3), np.array([0, 3]))
    assert digests.tolist() == [xxhash.xxh64_intdigest(b"one two three", 42)] and count.tolist() == [1]


def test_long_text_is_counted_in_steps():
    words = [b"w%d" % i for i in range(400)]
    rng = np.random.default_rng(0)
    index = rng.integers(0, 400, 300_000)
    digests, count = g._digests(words, index, np.array([0, 300_000]))
    ones = np.unpackbits(digests.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    want = np.packbits(2 * ones > len(digests), bitorder="little").view(np.uint64)[0]
    assert g._majority(digests, count)[0] == want


def test_edge_cases(spark):
    rows = [(1, "a b c d"), (2, "A  b c d"), (None, ""), (3, None), (None, "x"), (4, "x"), (4, "x"), (5, " \n"), (6, "é b " * 50), (7, "X y")]
    docs = spark.createDataFrame([(*r, "k", 0) for r in rows], "doc_id long, text string, fingerprint string, root long")
    got = [tuple(r)[:3] for r in g.simhash_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(brute.simhash(rows), key=str)
    assert g.simhash_groups(docs.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_simhash"](spark, SMALL).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.simhash(rows))


def test_many_copies_of_one_text(spark):
    """A fingerprint that most rows share, and near copies around it."""
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(i, text) for i in range(400)] + [(1000 + i, text + f" extra{i}") for i in range(40)] + [(2000 + i, f"other text number {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = sorted(tuple(r)[:3] for r in g.simhash_groups(docs, key_rows=4).collect())
    assert got == sorted(brute.simhash(rows))
