"""Registered queries of the package: thin wrappers that run each operator over
its whole table with production parameters and derive the digest columns."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.cdc_dedup import repeated_spans
from graphloom.llm.golay_simhash import simhash_groups
from graphloom.llm.lm_scoring import score_documents
from graphloom.llm.near_dedup import near_duplicates
from graphloom.llm.norm_topk import quantized, top_k
from graphloom.llm.packing import pack_documents
from graphloom.llm.pii_bootstrap import extract, found_spans, numbered_spans, span_text
from graphloom.llm.poisson_mixing import mix_sources
from graphloom.llm.prefix_trie import rebuilt_trie
from graphloom.llm import pu_toxicity
from graphloom.llm.quality_ledger import BASE, apply_policy, ledger
from graphloom.llm.sharding import shard_rows
from graphloom.llm.structure_repair import damaged, repair_conversations


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), pu_toxicity.fold(F.col("doc_id"), 10) == 0)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(read(spark, sf_dir, "documents"), path, with_ids=False)


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return shard_rows(read(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = pu_toxicity.train(docs, read(spark, sf_dir, "labels"), folds=5)
    return pu_toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        (pu_toxicity.fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("email", "ip", "card", "phone")
    found = extract(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(span_text(numbered_spans(base)), 256).alias("base_sha256"),
        span_text(F.concat(numbered_spans((*base, "secret")), found_spans())).alias("spans"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = apply_policy(apply_policy(ledger(read(spark, sf_dir, "documents"))), BASE, "_llm_base")
    return led.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        "n_repeat_words",
        "fail_bits",
        (~F.col("_llm_base")).alias("base_failed"),
        "kept",
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "n_chunks", "n_words", "first_doc_id"
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(read(spark, sf_dir, "conversations"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_mix_sources": op2_mix_sources,
    "op3_top_k": op3_top_k,
    "op4_near_dedup": op4_near_dedup,
    "op5_pack": op5_pack,
    "op6_shard": op6_shard,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_simhash": op11_simhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}
