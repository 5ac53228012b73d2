import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm import pu_toxicity
from graphloom.llm.pu_toxicity import fit_nnpu, fold, score, train

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    held = score(docs, model, keep=["doc_id"]).where(fold(F.col("doc_id"), 5) == 0).join(labels, "doc_id").select("score", "toxic").collect()
    s, y = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    assert (y == 1).sum() > 50
    assert (s[y == 1] >= 0.5).mean() > 0.85
    assert (s[y == 0] >= 0.5).mean() < 0.01
    order = np.argsort(s)
    ranks = np.empty(len(s))
    ranks[order] = np.arange(len(s))
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.96


def test_labels_of_the_held_out_fold_are_never_read(spark, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = train(docs, flipped)
    assert np.array_equal(other.weights, model.weights) and other.bias == model.bias


def test_odd_rows(spark, model):
    rows = [(1, None, 5.0), (2, "", 5.0), (None, "you idiot scum moron", 5.0), (4, "word " * 50_000, 5.0), (4, "word " * 50_000, 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = score(docs, model).collect()
    assert len(out) == 5 and out[0].score == out[1].score and out[3].score == out[4].score
    assert all(0 <= r.score <= 1 and isinstance(r.score, float) for r in out)
    assert out[2].score > out[1].score
    assert score(docs.limit(0), model).collect() == []


def test_training_without_positives_or_labels(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(20)] + [(None, None)], "doc_id long, text string")
    for rows in ([], [(None, 1), (3, None)], [(i, 0) for i in range(20)]):
        m = train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [round(r.score, 9) for r in score(docs, m).collect()] == [0.01] * 21
    # conflicting and repeated label rows: any 1 makes the document confirmed
    mixed = spark.createDataFrame([(i, i % 2) for i in range(20)] * 2 + [(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert len(score(docs, train(docs, mixed)).collect()) == 21


def test_risk_separates_positives_hidden_among_unlabelled():
    rng = np.random.default_rng(0)
    n = 4000
    toxic = rng.random(n) < 0.2
    positive = np.zeros(n, bool)
    positive[np.flatnonzero(toxic)[:200]] = True
    doc = np.repeat(np.arange(n), 3)
    feature = rng.integers(2, 30, 3 * n)
    feature[::3] = np.where(toxic, rng.integers(0, 2, n), feature[::3])
    w, b = fit_nnpu(doc, feature, np.ones(3 * n), positive, np.ones(n, bool), 0.2, 30)
    g = b + np.bincount(doc, weights=w[feature], minlength=n)
    assert ((g > 0) == toxic).mean() > 0.97


def test_prefixes_and_counts():
    row, f, n = pu_toxicity._counts(pa.array(["Idiot, idiot idiotic", "", None]), None)
    assert set(row.tolist()) == {0}
    assert sorted(n.tolist(), reverse=True)[:2] == [3, 2]  # the prefix of all three, the word of two


def test_samples_hold_repeated_ids_and_rows_once(spark, monkeypatch):
    rows = [(i, f"calm words number {i} here") for i in range(400)] + [(7, "calm words again and again")] * 3_000
    rows += [(1_000 + i, f"you idiot scum number {i}") for i in range(60)] + [(1_001, "you idiot scum repeated")] * 2_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0) for i in range(400)] + [(1_000 + i, 1) for i in range(60)], "doc_id long, toxic int")
    fitted = []
    real = fit_nnpu
    monkeypatch.setattr(pu_toxicity, "fit_nnpu", lambda d, f, v, pos, unl, *rest: fitted.append((int(pos.sum()), len(pos))) or real(d, f, v, pos, unl, *rest))
    out = score(docs, train(docs, labels)).select("doc_id", "score").distinct().collect()
    learned = [r for r in set(rows) if r[0] != 0 and zlib.crc32(str(r[0]).encode()) % 5]
    toxic = [r for r in learned if r[0] >= 1_000]
    assert fitted[0][0] == len(toxic) and abs(fitted[0][1] - len(learned)) <= 1
    assert all((r.score >= 0.5) == (r.doc_id >= 1_000) for r in out)
    train(docs, labels, positives=20, unlabelled=100)
    assert fitted[1][0] <= 40 and fitted[1][1] <= 200
