"""Uniform sharding with exact shard sizes through a hypergeometric communication matrix.

A uniform random permutation of N rows held in M blocks sends a number of rows
from block i to shard j that follows a multivariate hypergeometric law.  Those
counts are drawn first; each block is then permuted locally and cut at its
cumulative counts, rows are exchanged to their shard, and each shard is permuted
again.  Every permutation of the rows over the shards is equally likely and
every shard has exactly its size.

A block is a run of neighbouring input partitions, one alone while there are
few.  The law holds for any cut into blocks, so runs keep the matrix at
``MATRIX_CELLS`` numbers however many partitions the input has.
"""
from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.numbering import bucket_count, numbered
from graphloom.llm.scratch import materialize

SHARDS = 24
SEED = 20_240_229
MATRIX_CELLS = 1 << 16  # numbers of the matrix drawn on the driver and broadcast (8 bytes each)
_BLOCK_SHIFT = 33  # monotonically_increasing_id keeps the partition above this bit


def _stirling_error(n: int) -> float:
    """log(n!) less Stirling's formula; the series is exact to double rounding from 16 on."""
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi)
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n**2) / n**2) / n**2) / n


def _log_binomial(k: int, n: int, p: float) -> float:
    """log of C(n, k) p^k (1-p)^(n-k), by deviances: no difference of large logarithms."""
    if k == 0 or k == n:
        return n * (math.log1p(-p) if k == 0 else math.log(p))

    def deviance(x: int, mean: float) -> float:
        d = (x - mean) / mean
        return mean * ((1 + d) * math.log1p(d) - d)

    errors = _stirling_error(n) - _stirling_error(k) - _stirling_error(n - k)
    spread = 0.5 * (math.log(n) - math.log(k) - math.log(n - k) - math.log(2 * math.pi))
    return errors + spread - deviance(k, n * p) - deviance(n - k, n * (1 - p))


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good items in ``draws`` draws without replacement.

    Inversion outwards from the mode with the exact ratio of neighbouring
    probabilities, in O(standard deviation) steps.  The mode's probability is a
    ratio of binomial ones (Loader's saddle-point form), good to 1e-10 for
    populations of 10^13.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = draws / (good + bad)
    p_mode = math.exp(
        _log_binomial(mode, good, p) + _log_binomial(draws - mode, bad, p) - _log_binomial(draws, good + bad, p)
    )
    u = rng.random() - p_mode
    if u < 0:
        return mode
    up, down, p_up, p_down = mode, mode, p_mode, p_mode
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) / (up + 1) * (draws - up) / (bad - draws + up + 1)
            up += 1
            u -= p_up
            if u < 0:
                return up
        if down > low:
            p_down *= down / (good - down + 1) * (bad - draws + down) / (draws - down + 1)
            down -= 1
            u -= p_down
            if u < 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart; the first ``rows % shards`` shards take the extra row."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def communication_matrix(blocks: dict[int, int], sizes: list[int], seed: int) -> dict[int, list[int]]:
    """Rows of each block that go to each shard: rows sum to the block sizes,
    columns to the shard sizes, law multivariate hypergeometric."""
    rng = random.Random(seed)
    left = list(sizes)
    out: dict[int, list[int]] = {}
    for block in sorted(blocks):
        draws, rest, row = blocks[block], sum(left), []
        for room in left:
            rest -= room
            k = hypergeometric(rng, room, rest, draws)
            row.append(k)
            draws -= k
        left = [a - b for a, b in zip(left, row)]
        out[block] = row
    return out


def merged_blocks(partitions: int, shards: int) -> int:
    """Input partitions that make one block, so that blocks x shards stays within ``MATRIX_CELLS``."""
    return max(1, -(-partitions // max(1, MATRIX_CELLS // shards)))


def shard_rows(docs: DataFrame, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in the shard).

    Rows are told apart by their place in the input, so nulls, equal rows and
    repeated ids are ordinary rows; an empty frame gives an empty frame.
    Input columns named ``shard`` or ``slot`` are replaced.  The frame is
    written once to the checkpoint folder, which fixes its blocks (the input's
    own partitions, neighbours merged where they are many); ranks are computed on
    row ids alone and the rows move once.  The driver gets one count a block.
    """
    spark = docs.sparkSession
    kept = docs.drop("shard", "slot")
    base = materialize(kept.withColumn("_llm_rid", F.monotonically_increasing_id()), "shard-input")
    partition = F.shiftright("_llm_rid", _BLOCK_SHIFT)
    last = base.agg(F.max(partition)).first()[0]
    run = merged_blocks((last or 0) + 1, shards)
    ids = base.select("_llm_rid", F.floor(partition / run).cast("long").alias("_llm_block"))
    # one row per block: at most MATRIX_CELLS / shards, and one at least
    blocks = {r[0]: r[1] for r in ids.groupBy("_llm_block").count().collect()}
    rows = sum(blocks.values())
    matrix = communication_matrix(blocks, shard_sizes(rows, shards), seed)
    cuts = []
    for block, row in matrix.items():
        total, ends = 0, []
        for k in row:
            total += k
            ends.append(total)
        cuts.append((block, ends))
    cut_rows = spark.createDataFrame(cuts, "_llm_block long, _llm_cuts array<long>")

    def key(salt: str):
        return F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}:{salt}"), F.col("_llm_rid")), 4)

    in_block = Window.partitionBy("_llm_block").orderBy(key("block"), "_llm_rid")
    sent = (
        ids.withColumn("_llm_rank", F.row_number().over(in_block) - 1)
        .join(F.broadcast(cut_rows), "_llm_block")
        .select(
            "_llm_rid",
            F.expr("size(filter(_llm_cuts, c -> c <= _llm_rank))").cast("int").alias("shard"),
            key("slot").alias("_llm_key"),
        )
    )
    placed = numbered(
        sent, "_llm_key", "slot", buckets=bucket_count(rows, shards), group="shard", ties=[F.col("_llm_rid")]
    ).select("_llm_rid", "shard", "slot")
    return base.join(placed, "_llm_rid").drop("_llm_rid")
