import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import components, near_dedup, setsketch
from graphloom.llm.components import connected_components
from graphloom.llm.near_dedup import _load, _store, _verified_links, near_duplicates
from tests.llm import brute


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 40, 150)))]
        for _ in range(rng.choice((1, 2, 5, 40))):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(70)) for _ in range(40)]
    # a chain: each text close to the next, far from the one after
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for k in range(6):
        chain = chain[3:] + [rng.choice(vocabulary) for _ in range(3)]
        rows.append(" ".join(chain).upper() if k % 2 else "\n".join(chain))
    rng.shuffle(rows)
    texts = [(i * 3 % 1009, t) for i, t in enumerate(rows)]
    return texts + [(5000, None), (5001, ""), (5002, " \t"), (5003, "one"), (5004, "ONE"), (None, texts[0][1]), texts[1], (None, None), (None, "alone here"), (6000, "same " * 4000), (6001, "same " * 3000)]


@pytest.mark.parametrize("width,percent,small", [(3, 85, False), (5, 80, False), (3, 85, True)])
def test_matches_all_pairs(spark, monkeypatch, width, percent, small):
    if small:  # every path for groups too large for one task
        monkeypatch.setattr(near_dedup, "BUCKET_ROWS", 10)
        monkeypatch.setattr(near_dedup, "STAR_ROWS", 3)
        monkeypatch.setattr(near_dedup, "HUBS", 3)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, k, "clash") for k, (i, t) in enumerate(texts)], "doc_id long, text string, k long, node string")
    out = near_duplicates(docs.repartition(4), width=width, percent=percent, carry=("k",)).collect()
    got = {r.k: r for r in out}
    assert len(out) == len(texts) == len(got)
    want = brute.near_groups(texts, width, percent)
    for k, (i, t) in enumerate(texts):
        assert got[k].n_shingles == len(brute.shingles(t, width))
        assert got[k].component_id == want[k], (k, i)
    # exactly one row stands for each group; texts without words stand alone
    named = [(got[k].component_id) for k, (i, t) in enumerate(texts) if brute.words(t) and want[k] is not None]
    firsts = [got[k].component_id for k, (i, t) in enumerate(texts) if got[k].first and brute.words(t) and want[k] is not None]
    assert sorted(firsts) == sorted(set(named))
    assert all(got[k].first for k, (i, t) in enumerate(texts) if not brute.words(t))


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(2)
    for j in (0.2, 0.6, 0.9):
        n = 2000
        both = int(j * n)
        h = rng.integers(0, 1 << 64, n, np.uint64)
        rest = (n - both) // 2
        a, b = h[: both + rest], np.concatenate((h[:both], h[both + rest :]))
        ra, rb = setsketch.registers(a), setsketch.registers(b)
        ll = setsketch.log_likelihood(rb[None, :], np.array([len(b)]), ra, len(a))
        assert abs(setsketch.similarity(ll)[0] - j) < 0.12
        assert bool(setsketch.may_reach(ll, 0.85)[0]) == (j > 0.8)
        # mergeable: the union's sketch is the register-wise maximum
        assert np.array_equal(setsketch.registers(h), np.maximum(ra, rb))


def test_stored_sets_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 700):
        s = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        assert np.array_equal(_load(_store(s)), s >> np.uint64(16))


@pytest.mark.parametrize("per_part", [500_000, 7])
def test_components(spark, monkeypatch, per_part):
    monkeypatch.setattr(components, "EDGES_PER_PART", per_part)  # with few edges a part, the star steps decide
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 98), (5, 5), (200, 150), (150, 200), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r.node: r.root for r in connected_components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98, 150: 150, 200: 150}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def class_rows(spark, sets):
    """Classes as the operator stores them, from sets of hashes by node."""
    rows = [(n, len(s), bytearray(setsketch.registers(s)), bytearray(_store(s))) for n, s in sets.items()]
    return spark.createDataFrame(rows, "node long, n_shingles long, regs binary, shingles binary")


def test_bridge_between_two_large_components_of_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET_ROWS", 20)
    monkeypatch.setattr(near_dedup, "HUBS", 1)
    # the cluster of 30 has two parts; each component has one class that both parts share
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(2))
    hub = F.pmod(F.xxhash64(F.lit("hub"), "id"), F.lit(1 << 30)) < (1 << 30) / 30
    dealt = spark.range(2000).select("id", part.alias("part"), hub.alias("hub")).collect()
    hubs = [r.id for r in dealt if r.hub]
    halves = [[r.id for r in dealt if not r.hub and r.part == k] for k in (0, 1)]
    h = np.random.default_rng(5).integers(0, 1 << 64, 300, np.uint64)
    a, b = h[:100], np.concatenate((h[:70], h[100:130]))
    x, y = halves[0].pop(), halves[1].pop()  # the only similar pair over the components, in different parts
    sets = {x: np.concatenate((h[:90], h[100:110])), y: np.concatenate((h[:80], h[100:120]))}
    mine = [hubs.pop(), *halves[0][:7], *halves[1][:7]]
    other = [hubs.pop(), *halves[0][7:13], *halves[1][7:13]]
    for k, (n, core) in enumerate([(n, a) for n in mine] + [(n, b) for n in other]):
        sets[n] = np.concatenate((core, h[200 + k : 201 + k]))
    classes = class_rows(spark, {n: np.unique(s) for n, s in sets.items()})
    clusters = classes.select("node", F.lit(-1).cast("long").alias("root"))
    roots = connected_components(_verified_links(clusters, classes, 80)).collect()
    assert len(roots) == 30 and len({r.root for r in roots}) == 1


def test_tasks_of_large_groups_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET_ROWS", 20)
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    rng = random.Random(6)
    template = [f"t{i}" for i in range(110)]
    texts = []
    for i in range(240):  # one cluster of look-alikes, hardly any of them linked; every eighth has a close copy
        own = [rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(40)]
        texts.append((i, " ".join(template + own)))
        if i % 8 == 0:
            texts.append((1000 + i, " ".join(template + own[:-3] + ["x", "y", "z"])))
    held, plain = [], near_dedup.map_arrow

    def counted(df, task, schema, **options):
        if "part" in df.columns:
            rows = near_dedup.materialize(df, "counted")
            held.extend(r["count"] for r in rows.groupBy("key", "part").count().collect())
            df = rows.repartition("key", "part").sortWithinPartitions("key", "part", "node")
        return plain(df, task, schema, **options)

    monkeypatch.setattr(near_dedup, "map_arrow", counted)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, width=5, percent=80).collect()}
    assert got == dict(zip([i for i, _ in texts], brute.near_groups(texts, 5, 80)))
    assert held and max(held) <= 45  # two blocks of 10 on average, dealt by hash
