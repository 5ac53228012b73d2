"""Property graph: a vertex DataFrame and an edge DataFrame."""
from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PropertyGraph:
    """Directed property graph.

    ``vertices`` needs an ``id`` column, ``edges`` needs ``src`` and ``dst``;
    the three share one data type.  Every other column is a property.  Both
    sides stay lazy DataFrames: building a graph runs nothing.
    """

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self) -> None:
        if "id" not in self.vertices.columns:
            raise ValueError(f"vertices need an 'id' column, got {self.vertices.columns}")
        missing = [c for c in ("src", "dst") if c not in self.edges.columns]
        if missing:
            raise ValueError(f"edges need 'src' and 'dst' columns, missing {missing}")
        types = {
            "id": self.vertices.schema["id"].dataType,
            "src": self.edges.schema["src"].dataType,
            "dst": self.edges.schema["dst"].dataType,
        }
        if len({t.simpleString() for t in types.values()}) != 1:
            raise TypeError(f"id, src and dst must share one type, got {types}")

    @property
    def vertex_properties(self) -> list[str]:
        return [c for c in self.vertices.columns if c != "id"]

    @property
    def edge_properties(self) -> list[str]:
        return [c for c in self.edges.columns if c not in ("src", "dst")]

    # views ---------------------------------------------------------------
    def describe(self) -> DataFrame:
        from graphloom.operators.views import describe

        return describe(self)

    def triplets(self) -> DataFrame:
        from graphloom.operators.views import triplets

        return triplets(self)

    def fill_missing(self, defaults: dict[str, Any] | None = None) -> "PropertyGraph":
        from graphloom.operators.views import fill_missing

        return fill_missing(self, defaults or {})

    def dedupe_vertices(self) -> "PropertyGraph":
        from graphloom.operators.views import dedupe_vertices

        return dedupe_vertices(self)

    def valid_edges(self) -> "PropertyGraph":
        from graphloom.operators.views import valid_edges

        return valid_edges(self)

    def preview(self, side: str = "vertices", n: int = 20) -> DataFrame:
        from graphloom.operators.views import preview

        return preview(self, side, n)
