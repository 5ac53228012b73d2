"""The reference's built-in literal graphs, for tests and examples only.

They are fixed and tiny, so no registered query runs on them; the registered
queries run on graphs derived from the driver's tables.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from graphloom.graph import PropertyGraph

# The reference's literal inputs.
MAX_VALUE_VERTICES = [(1, 9), (2, 1), (3, 6), (4, 8)]
MAX_VALUE_EDGES = [(1, 2, 1), (2, 3, 1), (2, 4, 1), (3, 4, 1), (3, 1, 1)]
ROUTE_LABELS = [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E"), (6, "F")]
ROUTE_EDGES = [(1, 2, 4), (1, 3, 2), (2, 3, 5), (2, 4, 10), (3, 5, 3), (5, 4, 4), (4, 6, 11)]
ROUTE_SOURCE = 1
SOCIAL_VERTICES = [
    ("a", "Alice", 34),
    ("b", "Bob", 36),
    ("c", "Charlie", 30),
    ("d", "David", 29),
    ("e", "Esther", 32),
    ("f", "Fanny", 36),
    ("g", "Gabby", 60),
]
SOCIAL_EDGES = [
    ("a", "b", "friend"),
    ("b", "c", "follow"),
    ("c", "b", "follow"),
    ("f", "c", "follow"),
    ("e", "f", "follow"),
    ("e", "d", "friend"),
    ("d", "a", "friend"),
    ("a", "e", "friend"),
]

SOCIAL_VERTEX_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("age", T.IntegerType(), True),
    ]
)
SOCIAL_EDGE_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType(), True),
        T.StructField("dst", T.StringType(), True),
        T.StructField("relationship", T.StringType(), True),
    ]
)


def max_value_graph(spark: SparkSession) -> PropertyGraph:
    return PropertyGraph(
        spark.createDataFrame(MAX_VALUE_VERTICES, "id long, value long"),
        spark.createDataFrame(MAX_VALUE_EDGES, "src long, dst long, weight long"),
    )


def route_graph(spark: SparkSession) -> PropertyGraph:
    return PropertyGraph(
        spark.createDataFrame(ROUTE_LABELS, "id long, label string"),
        spark.createDataFrame(ROUTE_EDGES, "src long, dst long, weight long"),
    )


def route_labels(spark: SparkSession):
    return spark.createDataFrame(ROUTE_LABELS, "id long, label string")


def social_graph(spark: SparkSession) -> PropertyGraph:
    return PropertyGraph(
        spark.createDataFrame(SOCIAL_VERTICES, SOCIAL_VERTEX_SCHEMA),
        spark.createDataFrame(SOCIAL_EDGES, SOCIAL_EDGE_SCHEMA),
    )
