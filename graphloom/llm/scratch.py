"""Durable intermediate tables under the session's shared checkpoint folder.

Writing an intermediate as Parquet cuts its lineage in a way that survives the
loss of any executor, fixes row ids that depend on the physical plan, and lets
later passes read only the columns they need.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.session import checkpoint_dir, on_release

_OWNER: ContextVar[str] = ContextVar("owner", default="")
_TABLES: dict[tuple[str, str], list[str]] = {}  # (application, owner) -> paths
_CATALOG: dict[tuple[str, str], list[str]] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def owned(owner: str) -> Iterator[str]:
    """Tables written inside belong to ``owner`` (to the owner around, if there is
    one), whom :func:`release` can delete them for without touching any other's."""
    token = _OWNER.set(_OWNER.get() or owner)
    try:
        yield _OWNER.get()
    finally:
        _OWNER.reset(token)


def _mine(spark: SparkSession) -> tuple[str, str]:
    return spark.sparkContext.applicationId, _OWNER.get()


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffle files when it is done, not when the
    driver happens to collect its garbage; the written table stands for them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the checkpoint directory and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    _TABLES.setdefault(_mine(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def table(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table bucketed by ``key`` in the checkpoint directory and read
    it back: grouping or joining by the key then moves only the other side."""
    spark = df.sparkSession
    at = f"llm-{name}-{uuid.uuid4().hex}"
    path, table_name = f"{checkpoint_dir(spark)}/{at}", at.replace("-", "_")
    with _shuffles_dropped(spark):
        df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(table_name)
    _TABLES.setdefault(_mine(spark), []).append(path)
    _CATALOG.setdefault(_mine(spark), []).append(table_name)
    return spark.table(table_name)


def row_keyed(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """(``df`` with columns that tell its rows apart, their names).

    Rows read straight from Parquet files are known by file and place, however
    often and by however many tasks they are read; other frames are written
    once and numbered.
    """
    file, place = "_llm_file", "_llm_place"
    try:
        keyed = df.select(
            "*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place)
        )
        keyed.schema  # resolves now
        return keyed, [file, place]
    except AnalysisException:
        return materialize(df.withColumn(place, F.monotonically_increasing_id()), name), [place]


def release(spark: SparkSession, keep: str | None = None, owner: str | None = None) -> int:
    """Delete the tables this application materialised (those of ``owner``, if
    given), but those whose name starts with ``keep``; results that still read them
    must have been written or collected before.  Returns how many were deleted."""
    app = spark.sparkContext.applicationId
    jvm = spark._jvm
    gone = 0
    for key in [k for k in {*_TABLES, *_CATALOG} if k[0] == app and owner in (None, k[1])]:
        for name in _CATALOG.pop(key, []):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        paths = _TABLES.pop(key, [])
        kept = [p for p in paths if keep and p.rsplit("/", 1)[1].startswith(f"llm-{keep}")]
        if kept:
            _TABLES[key] = kept
        for p in paths:
            if p not in kept:
                path = jvm.org.apache.hadoop.fs.Path(p)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
                gone += 1
    return gone


on_release(release)
