"""Ordered reads and top-k.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
its own k best rows and only k rows per task reach the final merge, so no
full sort runs. Every top-k takes an explicit tie-break so results are
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(columns: str | Sequence[str] | None) -> tuple[str, ...]:
    """One column name, several, or none, as a tuple."""
    return (columns,) if isinstance(columns, str) else tuple(columns or ())


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def group_count_top(df: DataFrame, key: str, k: int = 10, out: str = "film_count") -> DataFrame:
    """``SELECT key, count(*) FROM t GROUP BY key ORDER BY count DESC LIMIT k``
    with the key as tie-break."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return top_k(counts, k, [F.col(out).desc(), F.col(key).asc_nulls_last()])
