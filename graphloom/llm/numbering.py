"""Gapless numbering by a random key without one task per group.

The key space is cut into equal buckets.  Bucket counts (groups x buckets
rows) give each bucket's first number, and a ``row_number`` inside each bucket
gives the rest, so no task ever sorts more than one bucket.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 100_000  # target size of one bucket
MAX_OFFSETS = 1_000_000  # offset rows that may be broadcast (24 bytes each)


def bucket_count(rows: int, groups: int = 1) -> int:
    """Buckets per group so that each holds about ``ROWS_PER_BUCKET`` rows."""
    return max(1, -(-rows // (groups * ROWS_PER_BUCKET)))


def numbered(
    df: DataFrame,
    key: str,
    out: str,
    *,
    buckets: int,
    group: str | None = None,
    ties: list[Column] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: 0-based gapless position by ``key`` (a non-negative 60-bit
    long) within ``group`` (the whole frame when None).

    ``counted`` is a frame with the same (group, key) rows that is cheaper to
    count than ``df`` (default ``df`` itself); both must be repeatable.
    """
    bucket = F.expr(f"cast(floor(cast({key} as double) / {float(1 << 60)!r} * {buckets}) as long)")
    groups = [F.col(group)] if group else []
    names = ([group] if group else []) + ["_llm_bucket"]
    src = (counted if counted is not None else df).select(*groups, bucket.alias("_llm_bucket"))
    counts = src.groupBy(*names).agg(F.count(F.lit(1)).alias("_llm_n"))
    before = Window.orderBy("_llm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        before = Window.partitionBy(group).orderBy("_llm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*names, F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_first"))
    if buckets <= MAX_OFFSETS // 64:  # at most buckets x groups small rows
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*names).orderBy(F.col(key), *(ties or []))
    ranked = df.withColumn("_llm_bucket", bucket).withColumn("_llm_rn", F.row_number().over(inside))
    return (
        ranked.join(offsets, names)
        .withColumn(out, (F.col("_llm_first") + F.col("_llm_rn") - 1).cast("long"))
        .drop("_llm_bucket", "_llm_rn", "_llm_first")
    )
