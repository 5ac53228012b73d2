"""Graph operators: Pregel loop, views, skew-aware joins, ordered successors, top-k."""
