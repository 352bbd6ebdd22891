"""What changed between two versions of a table, as multisets of rows.

A row's fingerprint is two independent 64-bit hashes over all its columns
(nulls marked, so a null and an empty string differ). Two versions are compared
by fingerprint: +1 for each new row and -1 for each old one, summed by (key,
fingerprint) before and after one shuffle of 24 bytes a row. What doesn't sum
to 0 has changed, with its multiplicity, so repeated rows count as often as
they occur. Only then are the few changed rows looked up.

Null keys are keys like others. Rows with equal keys are told apart by their
fingerprints alone; a key that holds a third of the rows is combined by
(key, fingerprint) in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import quoted

FINGERPRINT = ("_h1", "_h2")
WEIGHT = "weight"


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """The two hashes of a row."""
    cols = [F.col(quoted(c)) for c in columns]
    nulls = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(*cols, nulls).alias(FINGERPRINT[0]), F.xxhash64(F.lit(len(cols)), nulls, *reversed(cols)).alias(FINGERPRINT[1])]


def with_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` and its rows' fingerprints, unless it is stored with them."""
    if set(FINGERPRINT) <= set(df.columns):
        return df
    return df.select("*", *fingerprint(columns or df.columns))


def net_changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, fingerprint, net) of every row whose multiplicity differs."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        return with_fingerprint(df).select(*[F.col(quoted(k)) for k in key], *FINGERPRINT, F.lit(sign).cast("long").alias("net"))

    both = signed(new, 1).unionByName(signed(old, -1))
    return both.groupBy(*map(quoted, key), *FINGERPRINT).agg(F.sum("net").alias("net")).where("net <> 0")


def diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, status, rows_gone, rows_added): ``changed`` if a key has both."""
    net = net_changes(old, new, key)
    out = net.groupBy(*map(quoted, key)).agg(F.coalesce(F.sum(F.when(F.col("net") < 0, -F.col("net"))), F.lit(0)).alias("rows_gone"),
                                             F.coalesce(F.sum(F.when(F.col("net") > 0, F.col("net"))), F.lit(0)).alias("rows_added"))
    status = F.when(F.col("rows_gone") == 0, "added").when(F.col("rows_added") == 0, "gone").otherwise("changed")
    return out.select(*[F.col(quoted(k)) for k in key], status.alias("status"), "rows_gone", "rows_added")


def signed_rows(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The changed rows themselves with their ``weight``: +n for n more of a
    row, -n for n fewer. Loading them with their weights turns one version
    into the other (``plans.incremental``)."""
    columns = [c for c in new.columns if c not in FINGERPRINT]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return with_fingerprint(df).select(*[F.col(quoted(c)) for c in columns], *FINGERPRINT, F.lit(sign).alias("_sign"))

    # both versions meet the differences in one join, so those are found once
    net = net_changes(old, new, key).select(*FINGERPRINT, F.col("net").alias("_net"))
    mine = side(new, 1).unionByName(side(old, -1)).join(net, list(FINGERPRINT), "inner").where(F.col("_net") * F.col("_sign") > 0)
    # each distinct row once, with the difference as its weight
    return mine.drop("_sign").distinct().select(*[F.col(quoted(c)) for c in columns], F.col("_net").alias(WEIGHT))
