"""Corpus pipeline: toxicity, near-duplicates, personal data, source mixing, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over the documents
its predecessor kept.  Each stage's result is written as Parquet and read back
as the next stage's ``docs``; all but the last return the columns of
``documents``.  A stage first deletes the working tables that earlier stages of
the pipeline left in the checkpoint folder; other operators' stay.

Every stage takes null ids and texts, empty and very long texts, repeated rows,
empty tables and further columns: null and empty texts are documents like any
other, a repeated row is a row of its own, an empty table stays empty, and
columns beside those of ``documents`` are dropped.
"""
from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import pu_toxicity
from graphloom.llm.near_dedup import near_duplicates
from graphloom.llm.packing import pack_documents
from graphloom.llm.pii_bootstrap import redact
from graphloom.llm.poisson_mixing import mix_sources
from graphloom.llm.queries import read
from graphloom.llm.scratch import materialize, owned, release, row_keyed

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
SOURCE_ALPHA = 0.7  # target share of a source: its document count to this power


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def _stage(function: Callable) -> Callable:
    """The stages before have been written: what they worked with can go."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with owned("pipeline") as owner:
            release(spark, keep="stage-", owner=owner)
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score below 0.5).

    Learned from the labels of this folder on the documents given.  Null and
    empty texts, null ids and repeated rows are scored like any other row.
    """
    model = pu_toxicity.train(docs, read(spark, sf_dir, "labels"))
    base, key = row_keyed(_columns(docs), "pipeline-docs")
    scored = pu_toxicity.score(base.select(*key, "text"), model, keep=key, out="_llm_score")  # no other column goes to Python
    rejected = materialize(scored.where(F.col("_llm_score") >= 0.5).select(*key), "rejected")
    return _columns(base.join(rejected, key, "left_anti"))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group: the smallest id, then the
    first row.  Texts without words are groups of their own."""
    base, key = row_keyed(docs, "pipeline-docs")
    groups = near_duplicates(base.select("doc_id", "text", *key), width=SHINGLE_WORDS, percent=SIMILARITY_PERCENT, carry=tuple(key))
    dropped = groups.where(~F.col("first")).select(*key)
    return _columns(base.join(dropped, key, "left_anti"))


@_stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data in its text replaced by ``[PII]`` and
    ``n_chars`` set to the new length where the text changed."""
    masked = redact(_columns(docs).withColumn("_llm_old", F.md5(F.col("text").cast("binary"))))
    changed = ~F.md5(F.col("text").cast("binary")).eqNullSafe(F.col("_llm_old"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _columns(masked.withColumn("n_chars", n_chars))


@_stage
def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, globally shuffled."""
    return _columns(mix_sources(_columns(docs), alpha=SOURCE_ALPHA))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of 2048 token ids."""
    import public_tokenizers

    return pack_documents(_columns(docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mixing", mix_to_weights),
    ("packing", pack),
]

# A trained classifier and a tokenizer are no SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    with owned(f"pipeline-{uuid.uuid4().hex}") as owner:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            release(spark, keep=f"stage-{name}", owner=owner)
    return docs
