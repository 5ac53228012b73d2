"""Successor of each row in a per-group order, without a per-group task.

``lead(x) OVER (PARTITION BY g ORDER BY k)`` sorts every group in one task,
so a group holding a third of all rows is a third of the job in one task.
Here the rows are cut into *slices* of about equal row count along a numeric
key that never decreases along the order (``approxQuantile`` gives at most
``slices - 1`` cut points -- a bounded list on the driver -- and
``Bucketizer`` assigns each row its slice, JVM-side).  A key value that fills
whole slices (many rows at one exact time) becomes a slice of its own and is
cut again along a second key.  Then two window passes over one exchange:

1. inside each ``(group, slice)``: ``lead`` over the slice's rows, marking the
   slice's first and last row;
2. across slices: only those marked rows are ordered per group, and each
   slice's last row meets the next non-empty slice's first row.

A hot group is spread over many slices, a hot stretch of the key over many
cut points, and a hot key value over many cuts of the second key.  The slices
are a fixed function of the cut points computed once, so the two passes can
never disagree about where a slice ends.  Pass 2 holds at most two rows per
slice of a group.
"""
from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import shuffle_partitions


def _cut(rows: DataFrame, column: str, splits: list[float], out: str) -> DataFrame:
    if not splits:
        return rows.withColumn(out, F.lit(0.0))
    bounds = [float("-inf"), *splits, float("inf")]
    return Bucketizer(splits=bounds, inputCol=column, outputCol=out).transform(rows)


def _even_slices(rows: DataFrame, slices: int) -> DataFrame:
    """Add ``_slice``: ranges of (``_key``, ``_tie``) with about equal row counts."""
    probs = [i / slices for i in range(1, slices)]
    if not probs:
        return rows.withColumn("_slice", F.lit(0.0))
    keys, ties = rows.approxQuantile(["_key", "_tie"], probs, 1.0 / (10 * slices))
    # a value met by two quantiles or more holds a slice's worth of rows
    hot = sorted({a for a, b in zip(sorted(keys), sorted(keys)[1:]) if a == b})
    splits = sorted(set(keys) | {math.nextafter(h, math.inf) for h in hot})
    rows = _cut(rows, "_key", splits, "_slice")
    if not hot:
        return rows
    inner = sorted(set(ties))
    rows = _cut(rows, "_tie", inner, "_part")
    part = F.when(F.col("_key").isin(hot), F.col("_part")).otherwise(F.lit(0.0))
    return rows.withColumn("_slice", F.col("_slice") + part / float(len(inner) + 1)).drop("_part")


def successor_pairs(
    df: DataFrame,
    group: str,
    order: list[str],
    carry: list[str],
    slice_key: Column,
    *,
    tie_key: Column | None = None,
    slices: int | None = None,
) -> DataFrame:
    """For each row, its successor in the same ``group`` by ``order``.

    ``slice_key`` is numeric and must not decrease along ``order`` within a
    group (e.g. the first order key as a number), nor must ``tie_key`` among
    rows of one ``slice_key`` (e.g. the second order key); ``slices`` defaults
    to four per shuffle partition.  Output columns: ``group``, ``cur_<c>`` and
    ``next_<c>`` for each ``c`` in ``carry``; the last row of a group has no
    pair.  ``(group, *order)`` should be unique so that the order is total;
    rows with a NULL group, order key or slice key are left out.
    """
    n = slices or 4 * shuffle_partitions(df.sparkSession)
    keys = [group, *order]
    extra = [c for c in carry if c not in keys]
    tie = F.lit(0.0) if tie_key is None else F.coalesce(tie_key.cast("double"), F.lit(0.0))
    rows = df.select(*keys, *extra, slice_key.cast("double").alias("_key"), tie.alias("_tie"))
    for k in [*keys, "_key"]:
        rows = rows.where(F.col(k).isNotNull())
    rows = _even_slices(rows, n).drop("_key", "_tie")

    within = Window.partitionBy(group, "_slice").orderBy(*order)
    marked = rows.select(
        "*",
        F.row_number().over(within).alias("_rank"),
        F.lead(F.lit(True)).over(within).alias("_has_next"),
        *[F.lead(c).over(within).alias(f"next_{c}") for c in carry],
    )
    # 1. successor inside a slice
    inner = marked.where("_has_next").select(group, *_current(carry), *[f"next_{c}" for c in carry])
    # 2. last row of a slice -> first row of the next non-empty slice
    across_w = Window.partitionBy(group).orderBy("_slice", *order)
    across = (
        marked.where((F.col("_rank") == 1) | F.col("_has_next").isNull())
        .select(
            group,
            *_current(carry),
            "_has_next",
            F.lead(F.lit(True)).over(across_w).alias("_more"),
            *[F.lead(c).over(across_w).alias(f"next_{c}") for c in carry],
        )
        .where(F.col("_has_next").isNull() & F.col("_more"))
        .select(group, *[f"cur_{c}" for c in carry], *[f"next_{c}" for c in carry])
    )
    return inner.unionByName(across)


def _current(carry: list[str]) -> list[Column]:
    return [F.col(c).alias(f"cur_{c}") for c in carry]
