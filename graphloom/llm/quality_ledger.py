"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per failed rule, so a policy is only a mask over those bits:
policies can be versioned, applied and ablated later from the ledger alone,
without reading a text again.  Everything is a map over documents inside the
JVM: no shuffle, no Python.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8  # words per window of the repetition measure
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Rule name -> SQL condition for failing, over the measurements. The position is the bit.
RULES: dict[str, str] = {
    "too_short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "too_long": "n_words > 100000",
}

# Policy version -> rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("too_short", "repeats"),
    "v2": ("too_short", "repeats", "symbols", "word_length"),
    "strict": tuple(RULES),
}
BASE = "v1"
CURRENT = "v2"


def rule_bit(name: str) -> int:
    return 1 << list(RULES).index(name)


def policy_mask(version: str) -> int:
    return sum(rule_bit(r) for r in POLICIES[version])


def measure(docs: DataFrame) -> DataFrame:
    """The measurements of every document; a null or empty text counts as no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    d = docs.drop(*[c for c in names if c != "text"])
    # each step is referenced more than once by the next, so it is computed once per row
    d = d.withColumn("_llm_words", F.filter(F.split(text, SPACE, -1), lambda w: w != ""))
    d = d.withColumn("_llm_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("_llm_hash", F.transform("_llm_words", lambda w: F.xxhash64(w)))
    n = F.size("_llm_hash")
    d = d.withColumn(
        "_llm_win",
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("_llm_hash"), i, F.lit(WINDOW)))
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    repeated = F.size(F.array_distinct("_llm_win")) < F.size("_llm_win")
    d = d.withColumn(
        "_llm_sorted",
        F.when(
            repeated, F.sort_array(F.transform("_llm_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    # windows equal to a neighbour in hash order occur twice or more
    twice = F.filter(
        "_llm_sorted",
        lambda p, j: ((j > 0) & (F.get("_llm_sorted", j - 1)["h"] == p["h"]))
        | ((j < F.size("_llm_sorted") - 1) & (F.get("_llm_sorted", j + 1)["h"] == p["h"])),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda p: p["i"])),
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(s.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["at"])).alias("n")),
        lambda acc: acc["n"],
    )
    symbols = F.when(
        text.rlike("[#*$%&|<>]"), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    ).otherwise(F.lit(0))
    return d.select(
        *[F.col(c) for c in docs.columns if c not in names],
        F.size("_llm_words").cast("long").alias("n_words"),
        F.length(F.array_join("_llm_words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        F.size("_llm_lines").cast("long").alias("n_lines"),
        (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus ``fail_bits`` (long): bit i is set when rule i fails.

    Null and empty texts have no words and fail ``too_short``; repeated rows are
    judged alike; an empty frame gives an empty ledger.  Input columns with the
    names of measurements are replaced.
    """
    d = measure(docs.drop("fail_bits"))
    bits: Column = F.lit(0).cast("long")
    for name, failed in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(rule_bit(name))).otherwise(F.lit(0)).cast("long"))
    return d.withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, version: str = CURRENT, out: str = "kept") -> DataFrame:
    """Add ``out``: no rule of the policy failed."""
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0)


def ablation(led: DataFrame, versions: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """Per policy and rule: documents that fail it, that the policy rejects,
    and that only this rule rejects (kept if the rule were dropped).

    Works on the histogram of the bitmasks (at most 2 ** rules rows after a
    partial aggregation), never on documents again.
    """
    hist = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = [
        F.struct(
            F.lit(v).alias("policy"),
            F.lit(r).alias("rule"),
            F.lit(rule_bit(r)).cast("long").alias("bit"),
            F.lit(policy_mask(v)).cast("long").alias("mask"),
        )
        for v in versions
        for r in POLICIES[v]
    ]
    hits = F.expr("fail_bits & mask")
    return (
        hist.select("fail_bits", "n", F.explode(F.array(*rules)).alias("r"))
        .select("fail_bits", "n", "r.*")
        .groupBy("policy", "rule")
        .agg(
            F.sum(F.when(F.expr("fail_bits & bit") != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(hits != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(hits == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this_rule"),
        )
    )
