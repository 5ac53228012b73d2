"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its target share of the output
divided by what it holds.  Each document is repeated a Poisson number of
times, read off by inverting the distribution at a uniform number hashed from
the seed and the document id, so the mixture is repeatable and needs no
coordination between tasks.  Rows without an id, or with one that other rows
have too, are told apart by their content and, where that is equal as well, by
counting them.  The copies are then shuffled globally.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.numbering import bucket_count, numbered
from graphloom.llm.scratch import materialize
from graphloom.operators.joins import lookup_join

SEED = 7
ALPHA = 0.5  # target share of a source: its row count to this power, normalised
CONTENT = ("text", "lang", "source", "n_chars")  # columns that tell rows with one id apart
MAX_RATE = 32.0  # a larger rate is split into independent Poisson strata of at most this mean


def _hash60(*parts: Column) -> Column:
    """Non-negative 60-bit integer from SHA-256 of the joined parts."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def _poisson(rate: Column, uniform: Column) -> Column:
    """Number of cumulative probabilities of Poisson(rate) below ``uniform``."""
    steps = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int"))
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * rate / i
        return F.struct(
            p.alias("p"), (acc["c"] + p).alias("c"), (acc["k"] + (acc["c"] < uniform).cast("int")).alias("k")
        )

    return F.aggregate(steps, start, step, lambda acc: acc["k"])


def source_rates(
    docs: DataFrame, *, weights: dict[str, float] | None = None, alpha: float = ALPHA, budget: float | None = None
) -> DataFrame:
    """One row per source (null is a source): ``_llm_source``, ``rate``, ``strata``.

    ``weights`` are target shares by source name (missing sources get 0);
    without them the share is ``rows ** alpha``.  ``budget`` is the wanted
    number of output rows, by default as many as the input has.
    """
    per = docs.groupBy(_source_key(docs).alias("_llm_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(alpha)) if alpha != 0.5 else F.sqrt(F.col("n").cast("double"))
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("_llm_source") == F.lit(f"={name}"), F.lit(float(w))).otherwise(share)
    per = per.withColumn("share", share)
    total = per.agg(F.sum("share"), F.sum("n")).first()  # one row
    shares, rows = float(total[0] or 0), float(total[1] or 0)
    wanted = rows if budget is None else float(budget)
    rate = F.col("share") / F.lit(shares) * F.lit(wanted) / F.col("n") if shares > 0 else F.lit(0.0)
    rated = per.withColumn("rate", rate)
    strata = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE)).cast("int")
    return rated.select("_llm_source", (F.col("rate") / strata).alias("_llm_rate"), strata.alias("_llm_strata"))


def _source_key(docs: DataFrame) -> Column:
    return F.when(docs["source"].isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), docs["source"]))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_llm_name``, a text that no two rows share.

    A row's name is its id.  Where that is null or repeated, a digest of the
    other columns and a number among equal rows follow: equal rows are
    collapsed and counted (which combines map-side) and made again from the
    count, so no task numbers a group.
    """
    docs = docs.withColumn("_llm_name", F.col("doc_id").cast("string"))
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    shared = materialize(ids.where("n > 1").select("doc_id", F.lit(True).alias("_llm_shared")), "shared-ids")
    if shared.isEmpty() and docs.where(F.col("doc_id").isNull()).isEmpty():
        return docs
    flagged = lookup_join(docs, shared, "doc_id", "doc_id", how="left")
    unclear = F.col("doc_id").isNull() | F.col("_llm_shared").isNotNull()
    columns = [c for c in docs.columns if c != "_llm_name"]
    content = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in CONTENT if c in columns]
    others = [F.col(c) for c in columns if c not in ("doc_id", *CONTENT)]
    if others:
        content.append(F.xxhash64(*others).cast("string"))
    counted = flagged.where(unclear).groupBy(*columns).agg(F.count(F.lit(1)).alias("_llm_n"))
    again = counted.withColumn("_llm_nth", F.explode(F.expr("sequence(1L, _llm_n)"))).select(
        *columns,
        F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.concat_ws(":", *content)), F.col("_llm_nth")).alias("_llm_name"),
    )
    return flagged.where(~unclear).select(*columns, "_llm_name").unionByName(materialize(again, "unclear-ids"))


def _copies(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    rated = lookup_join(docs.withColumn("_llm_source", _source_key(docs)), rates, "_llm_source", "_llm_source")
    strata = rated.withColumn("_llm_stratum", F.explode(F.sequence(F.lit(1), F.col("_llm_strata"))))
    bits = F.shiftright(_hash60(F.lit(seed), F.lit("rate"), F.col("_llm_name"), F.col("_llm_stratum")), 8)
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    counted = strata.withColumn("_llm_k", _poisson(F.col("_llm_rate"), uniform)).where("_llm_k > 0")
    return (
        counted.withColumn("_llm_copy", F.explode(F.expr("sequence(1, _llm_k)")))
        .withColumn("_llm_order", _hash60(F.lit(seed), F.lit("order"), F.col("_llm_name"), F.col("_llm_stratum"), F.col("_llm_copy")))
        .drop("_llm_source", "_llm_rate", "_llm_strata", "_llm_k")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: dict[str, float] | None = None,
    alpha: float = ALPHA,
    budget: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``source``) replicated to the target
    weights, plus ``stratum``, ``copy`` (int, from 1) and ``position`` (long:
    place in the global shuffle, gapless from 0).

    A null source is a source of its own; rows with a null or shared id are drawn
    one by one like any others, equal rows too; an empty frame gives an empty
    frame.  Further columns may have any type that can be grouped, but maps.  Input columns with these output names are replaced.
    Rates above ``MAX_RATE`` are exact sums of independent Poisson strata, so
    any rate is inverted over a short table and a heavily repeated document is
    spread over rows before it is exploded.
    """
    docs = docs.drop("stratum", "copy", "position")
    rates = source_rates(docs, weights=weights, alpha=alpha, budget=budget)
    # the copies' order keys alone (no text) are enough to count buckets
    named = _named(docs)
    keys = _copies(named.select("_llm_name", "source"), rates, seed).select("_llm_order")
    buckets = bucket_count(int(budget) if budget is not None else docs.select("doc_id").count())
    buckets = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ties = [F.col("doc_id"), F.col("_llm_name"), F.col("_llm_stratum"), F.col("_llm_copy")]
    out = numbered(
        _copies(named, rates, seed), "_llm_order", "position", buckets=buckets, ties=ties, counted=keys
    )
    return out.withColumnsRenamed({"_llm_stratum": "stratum", "_llm_copy": "copy"}).drop("_llm_order", "_llm_name")
