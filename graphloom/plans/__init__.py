"""Algorithms, reports and the registered queries built from the operators."""
