"""Top-k rows per group without a per-group sort of the whole group."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import shuffle_partitions


def top_k_per_group(
    df: DataFrame,
    group: str,
    order: list[Column],
    k: int,
    *,
    salt_cols: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of each ``group`` by ``order`` (a total order).

    Two rounds: first per ``(group, salt)`` where the salt hashes ``salt_cols``
    into ``buckets`` slices, so a group with a third of all rows is ranked by
    many tasks; then per group over at most ``k * buckets`` survivors.
    The order must be total (break ties explicitly) for a repeatable result.
    """
    slices = buckets or shuffle_partitions(df.sparkSession)
    salt_on = salt_cols or [c for c in df.columns if c != group]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(slices)))
    first = salted.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order))
    ).where(F.col("_rank") <= k)
    second = first.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return second.where(F.col("_rank") <= k).drop("_salt", "_rank")
