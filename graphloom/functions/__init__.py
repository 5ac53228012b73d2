"""Column builders: vertex programs (send / merge / update) and result lines."""
from graphloom.functions.lines import cost_line, max_line, path_line, path_text
from graphloom.functions.programs import relax_min, relax_path, spread_max

__all__ = ["cost_line", "max_line", "path_line", "path_text", "relax_min", "relax_path", "spread_max"]
