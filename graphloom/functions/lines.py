"""Result lines, worded as the reference prints them."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the reference's result lines (must match).
COST_LINE = "Minimum cost to get from {source} to {target} is {cost}"
PATH_LINE = "Minimum cost to get from {source} to {target} is {path} with cost {cost}"
MAX_LINE = "{value} is the maximum value in the graph"
# The path is printed like a Java list: "[1, 3, 5, 4]".
PATH_OPEN, PATH_SEP, PATH_CLOSE = "[", ", ", "]"


def _fill(template: str, **cols: Column) -> Column:
    """Concatenate ``template`` with its fields replaced by columns (NULL if any is)."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(cols[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def path_text(path: Column) -> Column:
    """``[1, 3, 5, 4]`` for an array of ids."""
    return F.concat(F.lit(PATH_OPEN), F.array_join(path, PATH_SEP), F.lit(PATH_CLOSE))


def cost_line(source: Column, target: Column, cost: Column) -> Column:
    return _fill(COST_LINE, source=source, target=target, cost=cost)


def path_line(source: Column, target: Column, path: Column, cost: Column) -> Column:
    return _fill(PATH_LINE, source=source, target=target, path=path_text(path), cost=cost)


def max_line(value: Column) -> Column:
    return _fill(MAX_LINE, value=value)
