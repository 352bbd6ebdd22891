"""Tier labels from ordered cut points (a SQL CASE chain)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's tier cut points and labels.
BUDGET_CUTS = (10_000_000, 50_000_000, 150_000_000)
BUDGET_LABELS = ("Low Budget", "Mid Budget", "High Budget", "Blockbuster")
ROI_CUTS = (0, 100, 500)
ROI_LABELS = ("Loss", "Low Return", "Good Return", "Exceptional Return")


def bucket_label(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """``CASE WHEN c < cuts[0] THEN labels[0] ... ELSE labels[-1] END``.

    A NULL input fails every comparison and lands in the last label, as the
    SQL CASE does."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one more label than cut points")
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for cut, label in zip(cuts, labels):
        expr = F.when(c < F.lit(cut), label) if expr is None else expr.when(c < F.lit(cut), label)
    return F.lit(labels[-1]) if expr is None else expr.otherwise(labels[-1])
