"""graphloom: property graphs and Pregel-style iteration on Spark DataFrames."""
from graphloom.graph import PropertyGraph
from graphloom.operators.pregel import PregelResult, PreparedGraph, VertexProgram, messages, pregel
from graphloom.plans.algorithms import global_max, max_reach, sssp, sssp_paths, strength, walk_counts

__all__ = [
    "PropertyGraph",
    "PregelResult",
    "PreparedGraph",
    "VertexProgram",
    "global_max",
    "max_reach",
    "messages",
    "pregel",
    "sssp",
    "sssp_paths",
    "strength",
    "walk_counts",
]
