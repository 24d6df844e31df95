"""Buckets and guarded ratios, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper bounds (exclusive) of nodes + edges per complexity label.
COMPLEXITY_BOUNDS = ((50, "very low"), (200, "low"), (600, "medium"))
COMPLEXITY_ABOVE = "high"


def complexity(num_nodes: Column, num_edges: Column) -> Column:
    score = num_nodes + num_edges
    (first, label), *rest = COMPLEXITY_BOUNDS
    bucket = F.when(score < first, label)
    for bound, label in rest:
        bucket = bucket.when(score < bound, label)
    return bucket.otherwise(COMPLEXITY_ABOVE)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Null instead of a division by zero."""
    return F.when(whole != 0, F.round(part / whole, digits))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole != 0, F.round(part * 100 / whole, digits))
