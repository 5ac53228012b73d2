import numpy as np
from pyspark.sql import functions as F

from graphloom.llm.lm_scoring import pack, score_documents, unpack
from graphloom.llm.ngram_trie import ABSENT, Level, Rising, build, encode, probability, quantize
from tests.llm import brute


def image(values):
    h, packed, low, samples = encode(values)
    return b"".join(x.tobytes() for x in (h, samples, packed, low)) + b"\0" * 16


def test_rising_sequences_round_trip_and_search():
    rng = np.random.default_rng(5)
    for values in (
        np.empty(0, np.uint64),
        np.array([7], np.uint64),
        np.arange(3000, dtype=np.uint64),
        np.unique(rng.integers(0, 1 << 63, 150_000, np.uint64)),
        np.array([0, 1, (1 << 64) - 1], np.uint64),
    ):
        r = Rising(image(values), 0)
        assert np.array_equal(r.window(0, len(values)), values)
        assert np.array_equal(r.window(300, 900), values[300:900])
        wanted = np.unique(np.concatenate((values[::2], rng.integers(0, 1 << 63, 20, np.uint64))))
        at = r.find(wanted)
        place = {int(v): i for i, v in enumerate(values)}
        assert at.tolist() == [place.get(int(w), -1) for w in wanted]


def test_level_gives_smoothed_probabilities_and_backoff():
    keys = np.array([(1 << 8) | 3, (1 << 8) | 9, (5 << 8) | 0], np.uint64)
    level = Level(build(keys, np.array([3, 1, 2]), 8), 8)
    asked = np.array([3, (1 << 8) | 3, (1 << 8) | 4, (5 << 8) | 0, (9 << 8) | 0], np.uint64)
    direct, backoff = level.query(asked)
    assert direct[0] == direct[2] == direct[4] == ABSENT and backoff[0] == backoff[4] == 0
    assert abs(probability(direct[1:2])[0] / (3 / 6) - 1) < 0.05
    assert abs(probability(backoff[1:2])[0] / (2 / 6) - 1) < 0.05 and backoff[1] == backoff[2]
    assert abs(probability(direct[3:4])[0] / (2 / 3) - 1) < 0.05
    assert quantize(np.array([1e-30]))[0] == ABSENT - 1
    empty = Level(build(np.empty(0, np.uint64), np.empty(0, np.int64), 8), 8)
    assert empty.query(asked)[0].tolist() == [ABSENT] * 5


def test_masses_of_a_context_add_up_to_one_at_most():
    rng = np.random.default_rng(8)
    contexts = [[100], [50, 50], [1], [1] * 400, [10**9], [10**12, 1], *[rng.integers(1, 60, rng.integers(1, 30)).tolist() for _ in range(300)]]
    keys = np.array([(i << 10) | k for i, c in enumerate(contexts) for k in range(len(c))], np.uint64)
    level = Level(build(keys, np.array([n for c in contexts for n in c]), 10), 10)
    direct, backoff = level.query(keys)
    at = 0
    for c in contexts:
        mass = probability(direct[at : at + len(c)]).sum()
        left = probability(backoff[at : at + 1])[0]
        assert 0 < left and 0.9 < mass + left <= 1
        at += len(c)


def test_no_token_is_likelier_than_one(spark):
    docs = spark.createDataFrame([(i, "same " * 300) for i in range(40)] + [(40, "a b"), (41, "a c")], "doc_id long, text string")
    for r in score_documents(docs, F.col("doc_id") == 0).collect():
        assert r.score <= 0


def test_packed_integers_round_trip():
    rng = np.random.default_rng(1)
    for x in (np.empty(0, np.uint64), np.zeros(5, np.uint64), rng.integers(0, 1 << 63, 1000, np.uint64)):
        assert np.array_equal(unpack(pack(x)), x)
        assert np.array_equal(unpack(pack(np.sort(x), True), True), np.sort(x))


def test_scores_match_brute_force_with_odd_rows(spark):
    rows = [(i, f"the cat {'sat' if i % 3 else 'lay'} on the Mat number {i % 7} and the DOG ran {'x' * (i % 5)}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n "), (None, "the cat sat"), (103, "é É the"), (7, rows[7][1]), (7, "other")]
    rows += [(104, "long " * 3000 + "end")]
    docs = spark.createDataFrame([(i, t, "clash", 1.0, i) for i, t in rows], "doc_id long, text string, block string, score double, level long")
    out = score_documents(docs, F.when(F.col("doc_id").isNotNull(), F.pmod("doc_id", F.lit(4)) == 0))
    got = sorted(out.collect(), key=str)
    held = [i is None or i % 4 == 0 for i, _ in rows]
    want = []
    for (i, t), h, s in zip(rows, held, brute.lm_scores([t for _, t in rows], held)):
        want.append((i, h, *s))
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) <= 1e-9 * max(1, abs(w[5]))
        assert abs(g[6] - w[6]) <= 0.03 * w[2]  # one byte per probability
    assert score_documents(docs.limit(0), F.lit(True)).collect() == []
    # nothing to learn from: every token falls back to the base model
    alone = score_documents(docs.where("doc_id = 101"), F.lit(True)).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.score) == (1, 0, 0, alone.base_score)
