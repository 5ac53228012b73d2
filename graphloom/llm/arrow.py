"""Arrow tasks that can import this package on every executor."""
from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import graphloom

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(graphloom.__file__))
    # on the driver only, in a folder that outlives the application's last task
    path = os.path.join(tempfile.mkdtemp(prefix="graphloom-src-"), "graphloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.join("graphloom", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, task: Callable, schema: T.StructType, **options) -> DataFrame:
    """``df.mapInArrow`` with the package importable in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema, **options)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from a stream sorted by them; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new).tolist()
        for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == z:
                continue
            key = tuple(c[a] for c in cols)
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)
