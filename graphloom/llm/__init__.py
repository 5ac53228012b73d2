"""Training-data operators: scoring, mixing, search, dedup, packing, sharding, filtering.

Nothing else in the library imports this package; it imports general helpers
from the library (joins, session settings) and registers its own queries in
:mod:`graphloom.llm.queries`.
"""
