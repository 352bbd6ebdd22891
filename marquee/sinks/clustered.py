"""Tables in rank order: reads of the top skip everything below it.

A clustered table is dealt out by range of its order columns and sorted in
each range; a range is a folder (partition column ``_range``, 0 for the top). A
small table of the ranges (rows, smallest and largest first key) is written
beside it. A top-k read adds up rows from the first range on and filters on
``_range``, so the scan lists and opens only the folders that can hold the top;
a read by threshold does the same with the first key's bounds.

Ranges are cut on all order columns, so a key that holds a third of the rows
is spread over as many ranges as it needs if the other columns differ.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions.text import quoted
from marquee.sinks.tables import _exists, _read_text, _write_text, new_version_path, remove_path

RANGE = "_range"
#: Folder of the ranges' table below a version (Spark doesn't list names with an underscore).
RANGES = "_ranges"
SCHEMA = "_SCHEMA"

Order = Sequence[tuple[str, str]]       # (column, 'asc' or 'desc'); nulls last


def _by(order: Order) -> list[Column]:
    return [F.col(quoted(c)).desc_nulls_last() if way == "desc" else F.col(quoted(c)).asc_nulls_last() for c, way in order]


def write_clustered(df: DataFrame, path: str, order: Order, ranges: int) -> str:
    """``df`` in rank order below ``path``; returns the path."""
    spark, first = df.sparkSession, order[0][0]
    dealt = (df.repartitionByRange(ranges, *_by(order)).withColumn(RANGE, F.spark_partition_id())
             .sortWithinPartitions(F.col(RANGE), *_by(order)))
    dealt.write.partitionBy(RANGE).parquet(path)
    _write_text(spark, f"{path}/{SCHEMA}", dealt.schema.json())       # the files of an empty table don't tell it
    rows = spark.read.schema(dealt.schema).parquet(path)
    (rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"), F.min(quoted(first)).alias("least"), F.max(quoted(first)).alias("most"))
         .coalesce(1).write.parquet(f"{path}/{RANGES}"))
    return path


def refresh_clustered(spark: SparkSession, df: DataFrame, name: str, order: Order, ranges: int, root: str | None = None) -> str:
    """A new version of a clustered table; a failed write leaves no folder.
    Readers take the newest version that has its table of ranges."""
    path = new_version_path(spark, name, root)
    try:
        return write_clustered(df, path, order, ranges)
    except Exception:
        remove_path(spark, path)
        raise


class Clustered:
    """A version of a clustered table."""

    def __init__(self, spark: SparkSession, path: str, order: Order):
        if not _exists(spark, f"{path}/{RANGES}/_SUCCESS"):
            raise FileNotFoundError(f"{path}: no complete clustered table")
        self.spark, self.path, self.order = spark, path, order

    @property
    def ranges(self) -> DataFrame:
        """(_range, rows, least, most): one row a folder."""
        return self.spark.read.parquet(f"{self.path}/{RANGES}")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(_read_text(self.spark, f"{self.path}/{SCHEMA}")))).parquet(self.path)

    def _drop(self, df: DataFrame) -> DataFrame:
        return df.drop(RANGE)

    def all(self) -> DataFrame:
        return self._drop(self.rows())

    def sorted(self) -> DataFrame:
        """All rows in order. Folders are ranges already, so the range exchange
        of the sort moves neighbours only; the order is given by ``orderBy``."""
        return self._drop(self.rows().orderBy(RANGE, *_by(self.order)))

    def top(self, k: int) -> DataFrame:
        """The first ``k`` rows; folders behind them are not read."""
        last, found = -1, 0
        for r in self.ranges.orderBy(RANGE).toLocalIterator():      # at most as many rows as folders
            last, found = r[RANGE], found + r["rows"]
            if found >= k:
                break
        return self._drop(self.rows().where(F.col(RANGE) <= last)).orderBy(*_by(self.order)).limit(k)

    def at_least(self, value) -> DataFrame:
        """Rows whose first key is at least ``value`` (descending tables): the
        ranges that reach it are a prefix, and inside them the filter goes on
        to the files' own statistics."""
        first, way = self.order[0]
        if way != "desc":
            raise ValueError("at_least reads tables in descending order")
        reach = self.ranges.where(F.col("most") >= F.lit(value)).agg(F.max(RANGE)).first()[0]
        return self._drop(self.rows().where((F.col(RANGE) <= (-1 if reach is None else reach)) & (F.col(quoted(first)) >= F.lit(value))))


__all__ = ["Clustered", "RANGE", "refresh_clustered", "write_clustered"]
