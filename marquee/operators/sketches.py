"""Distinct counts that merge: HyperLogLog sketches stored by group.

A distinct count can't be added up over groups; a sketch can. ``title_sketches``
stores one sketch of the titles per country, year and tag (built where rows are
read and merged in the shuffle, so a hot group is one sketch per task), and
``merged_counts`` unions the stored sketches to any coarser grouping without
the rows. The sketches' standard error is 1.04 / sqrt(2 ** LG_K).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import quoted

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
#: Stated bound on the relative error: five standard errors.
BOUND = 5 * STANDARD_ERROR

#: Tasks that a group's distinct values are dealt out to.
PARTS = 4

GROUPS = ("country", "release_year", "genre")


def title_sketches(rows: DataFrame, groups: Sequence[str] = GROUPS, value: str = "title") -> DataFrame:
    """(groups, n_rows, sketch): one sketch of ``value`` per group.

    Equal rows are one before the sketches; a group then has its values dealt
    out to ``PARTS`` tasks, so sketches that a shuffle moves don't grow in
    number with the input's tasks."""
    names = list(map(quoted, groups))
    part = F.pmod(F.xxhash64("_v"), F.lit(PARTS)).alias("_part")
    values = rows.select(*names, F.col(quoted(value)).alias("_v")).groupBy(*names, "_v", part).agg(F.count(F.lit(1)).alias("_n"))
    parts = (values.repartition(*names, "_part").groupBy(*names, "_part")
             .agg(F.sum("_n").alias("n_rows"), F.hll_sketch_agg("_v", F.lit(LG_K)).alias("sketch")))
    return parts.groupBy(*names).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def groupings(groups: Sequence[str] = GROUPS) -> Column:
    """A row per grouping that a stored row belongs to: each group column on
    its own and all rows together."""
    each = [F.struct(F.lit(g).alias("grouping"), F.col(quoted(g)).cast("string").alias("value")) for g in groups]
    return F.explode(F.array(*each, F.struct(F.lit("all").alias("grouping"), F.lit(None).cast("string").alias("value"))))


def merged_counts(sketches: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """(grouping, value, n_rows, estimate) from stored sketches alone."""
    parts = sketches.select("n_rows", "sketch", groupings(groups).alias("g")).select("n_rows", "sketch", "g.*")
    return parts.groupBy("grouping", "value").agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def exact_counts(rows: DataFrame, groups: Sequence[str] = GROUPS, value: str = "title") -> DataFrame:
    """(grouping, value, titles): the same by exact counting. Equal rows are
    one before they are dealt by their value; where a value stands, each
    grouping it belongs to counts it once, so only counts are shuffled then."""
    distinct = rows.select(F.col(quoted(value)).alias("_v"), *map(quoted, groups)).distinct()
    parts = distinct.repartition("_v").select("_v", groupings(groups).alias("g")).select("_v", "g.*").distinct()
    return parts.groupBy("grouping", "value").agg(F.count("_v").alias("titles"))


def accuracy(sketches: DataFrame, rows: DataFrame, groups: Sequence[str] = GROUPS, value: str = "title", bound: float = BOUND) -> DataFrame:
    """(grouping, value, n_rows, titles, within_bound): estimates from merged
    sketches held against exact counts."""
    est, exact = merged_counts(sketches, groups), exact_counts(rows, groups, value)
    on = (est["grouping"] == exact["grouping"]) & est["value"].eqNullSafe(exact["value"])
    return est.join(exact, on).select(est["grouping"], est["value"], "n_rows", "titles",
                                      (F.abs(F.col("estimate") - F.col("titles")) <= F.lit(bound) * F.col("titles")).alias("within_bound"))
