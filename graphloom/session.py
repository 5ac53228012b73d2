"""Session-level settings the library reads (never overrides)."""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count; the loop keeps its state on it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 means never broadcast."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint directory of the session.

    The directory the context already has, else ``spark.checkpoint.dir``, else
    (only where the session runs in one process) a folder of the warehouse.
    A cluster session without a shared folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured and re.fullmatch(r"local(\[.*\])?", sc.master):
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if not configured:
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared (distributed) folder: the iterative "
            "operators cut lineage with reliable checkpoints"
        )
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_CLEANERS: list[Callable[[SparkSession], object]] = []


def on_release(cleaner: Callable[[SparkSession], object]) -> None:
    """Register what :func:`release_all` calls to delete one kind of working table."""
    _CLEANERS.append(cleaner)


def release_all(spark: SparkSession) -> None:
    """Delete every working table the operators left in the checkpoint folder.
    Results that still read them must have been written or collected before."""
    for cleaner in _CLEANERS:
        cleaner(spark)
