"""Skew-aware joins.

A fact side may hold a third of its rows under one key.  A plain shuffle join
sends all of them to one task, so the keys that hold more than an average
partition are found first (partial aggregation, no skew) and joined through a
broadcast of their -- bounded -- dimension rows, while the rest takes the
ordinary shuffle.  A dimension whose measured size fits the broadcast
threshold is simply broadcast whole.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.session import broadcast_threshold, shuffle_partitions

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _bound_terms(df: DataFrame) -> tuple[int, list[Column]] | None:
    """(fixed bytes per row, columns measuring the variable part) or None."""
    per_row = 0
    lengths: list[Column] = []
    for field in df.schema.fields:
        width = _FIXED_WIDTH.get(type(field.dataType))
        if width is not None:
            per_row += width + 8
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row += 8
            lengths.append(F.max(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))))
        elif isinstance(field.dataType, T.DecimalType):
            per_row += 16 + 8
        else:
            return None
    return per_row, lengths


def size_bounds(frames: list[DataFrame]) -> list[int | None]:
    """Upper bounds in bytes of several frames from one job: row count times
    (fixed widths + the longest value of each string/binary column + 8 bytes
    per column).  None for a frame with a column that has no such bound."""
    parts: list[DataFrame] = []
    fixed: dict[int, int] = {}
    for i, df in enumerate(frames):
        terms = _bound_terms(df)
        if terms is None:
            continue
        fixed[i], lengths = terms
        widest = sum(lengths, F.lit(0)) if lengths else F.lit(0)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("_rows"), widest.cast("long").alias("_widest")).select(
                F.lit(i).alias("_frame"), "_rows", "_widest"
            )
        )
    if not parts:
        return [None] * len(frames)
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    measured = {r["_frame"]: (r["_rows"], r["_widest"]) for r in union.collect()}  # one row per frame
    out: list[int | None] = []
    for i in range(len(frames)):
        if i not in measured:
            out.append(None)
        else:
            rows, widest = measured[i]
            out.append(int(rows) * (fixed[i] + int(widest or 0)))
    return out


def size_bound(df: DataFrame) -> int | None:
    return size_bounds([df])[0]


def fits_broadcast(spark, bound: int | None) -> bool:
    limit = broadcast_threshold(spark)
    return limit >= 0 and bound is not None and bound <= limit


@dataclass(frozen=True)
class KeyProfile:
    """Row count of a frame and the keys that hold more than ``threshold`` rows.

    ``hot`` holds at most ``total / threshold`` keys (never more than the
    partition count), which is what makes them safe as literals and their
    dimension rows safe to broadcast.
    """

    total: int
    max_rows: int
    threshold: int
    hot: list


def profile_keys(df: DataFrame, key: str, *, partitions: int | None = None) -> KeyProfile:
    """Count rows per key and flag keys heavier than an average partition.

    One job (scan + partial aggregate); a second, small one only when a hot key
    exists.  Null keys never match an equi-join and are not counted as hot.
    """
    parts = partitions or shuffle_partitions(df.sparkSession)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    row = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("max_rows")).first()
    total = int(row["total"] or 0)
    max_rows = int(row["max_rows"] or 0)
    threshold = max(1, math.ceil(total / parts))
    if total == 0 or max_rows <= threshold or parts == 1:
        return KeyProfile(total, max_rows, threshold, [])
    hot = counts.where(F.col("_rows") > threshold).select(key).collect()
    return KeyProfile(total, max_rows, threshold, [r[0] for r in hot])


def split_hot(df: DataFrame, key: str, profile: KeyProfile) -> tuple[DataFrame, DataFrame | None]:
    """(rows with an ordinary key, rows with a hot key or None)."""
    if not profile.hot:
        return df, None
    is_hot = F.coalesce(F.col(key).isin(profile.hot), F.lit(False))  # a null key is an ordinary one
    return df.where(~is_hot), df.where(is_hot)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    *,
    how: str = "inner",
    profile: KeyProfile | None = None,
    dim_bound: int | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dim`` (unique on ``dim_key``) without a skewed task.

    If the dimension's measured size bound (``dim_bound``, measured here when
    not given) fits the session's broadcast threshold it is broadcast (no
    shuffle, so no skew).  Otherwise the fact's
    hot keys are found (``profile`` may be passed in) and only their dimension
    rows -- at most one per hot key -- are broadcast; the other keys take a
    shuffle join.  The key column keeps the fact's name.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    d = dim.withColumnRenamed(dim_key, fact_key) if dim_key != fact_key else dim
    if profile is None:
        spark = fact.sparkSession
        bound = dim_bound if dim_bound is not None else (size_bound(d) if broadcast_threshold(spark) >= 0 else None)
        if fits_broadcast(spark, bound):
            return fact.join(F.broadcast(d), fact_key, how)
    prof = profile if profile is not None else profile_keys(fact, fact_key)
    cold, hot = split_hot(fact, fact_key, prof)
    joined = cold.join(d, fact_key, how)
    if hot is None:
        return joined
    hot_dim = d.where(F.col(fact_key).isin(prof.hot))
    return joined.unionByName(hot.join(F.broadcast(hot_dim), fact_key, how))


def not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
