"""Toxicity by non-negative positive-unlabelled learning.

The confirmed toxic documents are the positives; a sample of all documents,
toxic or not, is the unlabelled set.  With the class prior known from the
labelled rows, the risk of a classifier can be written from these two sets
alone: prior * R+(positives as toxic) + max(0, R-(unlabelled as clean) - prior
* R-(positives as clean)).  The clamp keeps the estimated clean risk from going
negative, where a flexible model would only memorise.  A linear numpy model
over hashed words and word prefixes is trained on that risk.  Spark counts the
features over all learnable documents to choose the model's, gathers the
sample's counts of these, and scores every document.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.scratch import materialize
from graphloom.llm.tokens import chunks, hash_strings, lower_ascii, words

POSITIVES = 8_000  # expected number of confirmed toxic documents fitted on, at most
UNLABELLED = 24_000  # expected number of unlabelled documents fitted on, at most
FEATURES = 4_096  # features kept for the model
PER_POSITIVE = 4  # and at most this many per fitted toxic document
HASH_BITS = 20
MAX_BROADCAST_IDS = 1 << 20  # confirmed toxic ids up to which they are broadcast; more are joined by a shuffle
PREFIXES = (4, 5, 6, 7)  # word prefixes that are features, in characters
TRIM = ".,;:!?\"'()[]"
ITERATIONS = 400
RATE = 0.05
L2 = 3e-5
CHUNK_BYTES = 8 << 20


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each distinct word, or -1; word index of every word; starts of texts)."""
    distinct, index, starts = words(lower_ascii(texts))
    bare = pc.utf8_trim(distinct, characters=TRIM)
    length = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    mask = np.uint64((1 << HASH_BITS) - 1)
    cols = []
    for n in (0, *PREFIXES):
        some = length > n
        h = np.full(len(length), -1, np.int64)
        part = bare.filter(pa.array(some))
        part = pc.utf8_slice_codeunits(part, 0, n) if n else part
        coded = part.dictionary_encode()  # prefixes repeat: hash each once
        hashes = (hash_strings(coded.dictionary, n) & mask).astype(np.int64)
        h[some] = hashes[coded.indices.to_numpy()]
        cols.append(h)
    return np.stack(cols, 1), index, starts


def _counts(texts: pa.Array, column: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) triples; with ``column`` only features it maps to >= 0, so mapped."""
    table, index, starts = _features(texts)
    if column is not None:
        table = np.where(table >= 0, column[table], -1)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    useful = (table >= 0).any(1)[index]
    row, f = row[useful], table[index[useful]]
    at = np.repeat(row, f.shape[1])
    f = f.ravel()
    key, n = np.unique((at[f >= 0] << HASH_BITS) | f[f >= 0], return_counts=True)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1), n


@dataclass(frozen=True)
class ToxicityModel:
    """Linear model: ``column`` maps a hashed feature to its weight's index (-1: unused)."""

    column: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, f, n = _counts(texts, self.column)
        g = self.bias + np.bincount(row, weights=np.log1p(n) * self.weights[f], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(g, -500, 500)))


def fit_nnpu(
    doc: np.ndarray, feature: np.ndarray, value: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray,
    prior: float, features: int, *, iterations: int = ITERATIONS, rate: float = RATE, l2: float = L2,
) -> tuple[np.ndarray, float]:
    """Adam on the non-negative PU risk with the logistic loss.

    ``doc``/``feature``/``value`` are sparse entries; ``positive`` and
    ``unlabelled`` flag rows (a row may be both).  Where the clean risk is
    negative the step ascends it, as the estimator prescribes.
    """
    rows = len(positive)
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int(unlabelled.sum()))
    w = np.zeros(features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, iterations + 1):
        g = np.clip(w[-1] + np.bincount(doc, weights=value * w[feature], minlength=rows), -30, 30)
        s = 1 / (1 + np.exp(-g))
        as_clean = np.log1p(np.exp(g))
        clean_risk = as_clean[unlabelled].sum() / n_unl - prior * as_clean[positive].sum() / n_pos
        d_clean = unlabelled * s / n_unl - prior * positive * s / n_pos
        d = d_clean - prior * positive * (1 - s) / n_pos if clean_risk >= 0 else -d_clean
        grad = np.append(np.bincount(feature, weights=value * d[doc], minlength=features), d.sum())
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, mod ``folds``; a null id is fold 0 (held out)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def _drawn(size: int, total: int, salt: str) -> Column:
    """True for rows (``doc_id``, ``_h``: hash of the text) whose hash leaves about ``size`` of ``total``."""
    if total <= size:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit(salt), "doc_id", "_h"), F.lit(1 << 40)) < int((1 << 40) * size / total)


def train(
    docs: DataFrame, labels: DataFrame, *, folds: int = 5,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES,
) -> ToxicityModel:
    """Fit on documents outside fold 0.

    ``positives`` and ``unlabelled`` bound the expected size of the two samples
    the weights are fitted on.  They are drawn by hashed (id, text) and hold
    equal rows once, so an id or a row that repeats cannot swell them.  The
    features are chosen by counts over all learnable rows.  A document is
    confirmed toxic if any of its label rows says so; null labels and ids are
    ignored.  Without positives the model gives every text the score 0.01.
    """
    learn = fold(F.col("doc_id"), folds) != 0
    known = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p")).first()
    n, p = int(total["n"]), int(total["p"] or 0)
    empty = ToxicityModel(np.full(1 << HASH_BITS, -1, np.int32), np.zeros(1), float(np.log(0.01 / 0.99)), 0.0)
    if p == 0:
        return empty
    prior = min(max(p / n, 1e-4), 0.9)
    learnable = docs.select("doc_id", "text").where(learn & F.col("doc_id").isNotNull())
    confirmed = known.where("toxic = 1").select("doc_id", F.lit(True).alias("pos"))
    flagged = learnable.join(F.broadcast(confirmed) if p <= MAX_BROADCAST_IDS else confirmed, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("pos", F.lit(False)).alias("pos"), F.xxhash64("text").alias("_h")
    )
    schema = T.StructType([T.StructField("f", T.LongType()), T.StructField("p", T.LongType()), T.StructField("u", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << HASH_BITS  # feature ``size`` counts the rows
        p, u = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        for b in chunks(batches, limit=CHUNK_BYTES):
            row, f, _ = _counts(b.column("text"), None)
            pos = b.column("pos").to_numpy(zero_copy_only=False)
            p[:size] += np.bincount(f[pos[row]], minlength=size)
            u[:size] += np.bincount(f, minlength=size)
            p[size] += int(pos.sum())
            u[size] += b.num_rows
        at = np.flatnonzero(u)
        for x in range(0, len(at), 1 << 16):
            some = at[x : x + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(p[some]), pa.array(u[some])], names=["f", "p", "u"])

    # a task sends each feature once; together at most 2^HASH_BITS + 1 rows
    counted = materialize(
        map_arrow(flagged.select("text", "pos"), count, schema).groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u")),
        "pu-features",
    )
    sizes = counted.where(F.col("f") == 1 << HASH_BITS).first()
    n_p, n_u = (int(sizes["p"]), int(sizes["u"])) if sizes else (0, 0)
    if n_p == 0:
        return empty
    in_pos, in_unl = F.col("pos") & _drawn(positives, n_p, "positive"), _drawn(unlabelled, n_u, "unlabelled")
    sample = (
        flagged.select("doc_id", "text", "_h", in_pos.alias("pos"), in_unl.alias("unl")).where("pos or unl")
        .groupBy("doc_id", "_h").agg(*[F.first(c).alias(c) for c in ("text", "pos", "unl")])
        .select("text", "pos", "unl")
    )
    a, b = F.col("p") / n_p, F.col("u") / n_u
    z = F.abs(a - b) / F.sqrt(F.greatest(a, b) * (1 - F.least(a, b)) / n_p + 1e-9)
    picked = (
        counted.where((F.col("f") < 1 << HASH_BITS) & (F.col("p") + F.col("u") >= 3)).orderBy(z.desc(), "f")
        .limit(min(features, PER_POSITIVE * n_p)).select("f").collect()
    )  # at most ``features`` rows
    column = np.full(1 << HASH_BITS, -1, np.int32)
    column[[r["f"] for r in picked]] = np.arange(len(picked), dtype=np.int32)
    entry = T.StructType(
        [T.StructField("pos", T.BooleanType()), T.StructField("unl", T.BooleanType()), T.StructField("f", T.BinaryType()), T.StructField("n", T.BinaryType())]
    )

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, limit=CHUNK_BYTES):
            row, f, n = _counts(b.column("text"), column)
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            fs = [f[x:y].astype("<u2").tobytes() for x, y in zip(cut[:-1], cut[1:])]
            ns = [n[x:y].astype("<u4").tobytes() for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([b.column("pos"), b.column("unl"), pa.array(fs, pa.binary()), pa.array(ns, pa.binary())], names=entry.names)

    # one short record per sampled document: bounded by the sample sizes
    rows = map_arrow(sample, entries, entry).collect()
    rows.sort(key=lambda r: (r["f"], r["n"], r["pos"], r["unl"]))  # the fit does not depend on row order
    fs = [np.frombuffer(r["f"], "<u2") for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in fs])
    feature = np.concatenate([*fs, np.empty(0, "<u2")]).astype(np.int64)
    value = np.log1p(np.concatenate([*(np.frombuffer(r["n"], "<u4") for r in rows), np.empty(0, "<u4")]).astype(np.float64))
    flags = np.array([(r["pos"], r["unl"]) for r in rows], bool).reshape(-1, 2)
    weights, bias = fit_nnpu(doc, feature, value, flags[:, 0], flags[:, 1], prior, max(1, len(picked)))
    return ToxicityModel(column, weights, bias, prior)


def score(docs: DataFrame, model: ToxicityModel, *, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``docs`` (or its ``keep`` columns) plus ``out``: probability of being toxic.

    Null and empty texts get the score of a text without known words.  An input
    column named like ``out`` is replaced; an empty frame gives an empty frame.
    The model (about 4 MB, fixed by ``HASH_BITS``) is broadcast.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c != out]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, limit=CHUNK_BYTES):
            s = pa.array(shared.value.scores(b.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), s], names=schema.names)

    return map_arrow(docs.select(*dict.fromkeys([*columns, "text"])), run, schema)
