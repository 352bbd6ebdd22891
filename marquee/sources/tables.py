"""Table sources: parquet tables, catalog tables, external databases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


_HANDLES: dict[tuple[int, str, str], DataFrame] = {}


def read_table(spark: SparkSession, root: str, name: str,
               columns: Sequence[str] | None = None, refresh: bool = False) -> DataFrame:
    """Parquet table ``{root}/{name}.parquet``; an explicit projection so the
    scan's ReadSchema holds only what the job uses.

    The resolved relation (file listing + footer schema) is kept per session
    and path, so building many queries over the same tables resolves each
    table once. It holds no data; ``refresh=True`` re-lists the files.
    """
    path = f"{root.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = None if refresh else _HANDLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _HANDLES[key] = df
    return df.select(*columns) if columns else df


def read_for_counts(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder through Spark's second-generation file source, whose
    scans answer ``count(*)``, ``min`` and ``max`` from the files' footers
    (``PushedAggregation`` in the plan): no data page is read. Partial results
    come from the tasks, one row a file, and are added up as usual."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    setting = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(setting, None)
    try:
        spark.conf.set(setting, "")         # which source a read takes is settled when it is built
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """External database table. Give a numeric ``partition_column`` with
    bounds so the read runs as parallel range queries, not one connection."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)
