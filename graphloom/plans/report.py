"""Labelled results: label lookups per row and per path element, result lines.

A result row's id is unique, so its label takes a plain join.  The source and
the steps of a path repeat (with one source, every row has it), so they go
through the skew-aware lookup join: a label table of measured small size is
broadcast, beyond it the hot keys are split off.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.lines import cost_line, path_line
from graphloom.operators.joins import lookup_join, size_bounds


def with_label(df: DataFrame, labels: DataFrame, key: str = "id", name: str = "label") -> DataFrame:
    """Left-join ``labels(id, label)`` on a key that is unique in ``df``; a
    missing label is NULL."""
    return df.join(labels.select(F.col("id").alias(key), F.col("label").alias(name)), key, "left")


def _repeated_label(df: DataFrame, labels: DataFrame, key: str, name: str, bound: int | None) -> DataFrame:
    """As :func:`with_label` for a key that many rows may share."""
    lab = labels.select(F.col("id").alias(key), F.col("label").alias(name))
    return lookup_join(df, lab, key, key, how="left", dim_bound=bound)


def labelled_costs(costs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label, source_label, dist, line) from costs (id, dist, source), or from
    paths (id, dist, path), whose first element is the source.

    Unreached vertices keep NULL cost, source and line.
    """
    if "source" not in costs.columns:
        costs = costs.withColumn("source", F.col("path")[0])
    labels = labels.select("id", "label")
    reached = costs.select("id", "dist", F.when(F.col("dist").isNotNull(), F.col("source")).alias("source"))
    out = _repeated_label(with_label(reached, labels), labels, "source", "source_label", size_bounds([labels])[0])
    return out.select(
        "id",
        "label",
        "source_label",
        "dist",
        cost_line(F.col("source_label"), F.col("label"), F.col("dist")).alias("line"),
    )


def path_labels(paths: DataFrame, labels: DataFrame, sep: str = ">") -> DataFrame:
    """(id, dist, path_labels, line): every id of a path replaced by its label.

    The path is exploded with positions, labelled through a join and put back
    in order; a group holds exactly one path, which already lived in one row.
    """
    labels = labels.select("id", "label")
    bound = size_bounds([labels])[0]
    steps = paths.select("id", F.posexplode("path").alias("pos", "step"))
    named = (
        _repeated_label(steps, labels, "step", "name", bound)
        .select("id", "pos", F.coalesce("name", F.col("step").cast("string")).alias("name"))
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("_steps"))
        .select("id", F.array_join(F.col("_steps.name"), sep).alias("path_labels"))
    )
    head = with_label(paths.select("id", "dist", "path", F.col("path")[0].alias("source")), labels)
    head = _repeated_label(head, labels, "source", "source_label", bound)
    return head.join(named, "id", "left").select(
        "id",
        "dist",
        "path_labels",
        path_line(F.col("source_label"), F.col("label"), F.col("path"), F.col("dist")).alias("line"),
    )
