"""Refresh of a stored table that rewrites only what changed.

The table is partitioned by hash of the row key and stored with its rows'
fingerprints. A refresh reads the stored keys and fingerprints (three narrow
columns, not the rows), compares them with the new version's, and rewrites the
partitions that hold a change into a new folder. The folder's counts are
checked before the partitions are pointed to it, one metadata operation each;
untouched partitions keep their files. A failed write changes nothing; a
refresh that is cut off between two partitions is completed by the next one,
as the difference is then what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import quoted
from marquee.operators.changes import FINGERPRINT, net_changes, with_fingerprint
from marquee.sinks.tables import RefreshError, _ddl, hand_off, new_version_path, remove_path

PART = "_part"


def stored_rows(spark: SparkSession, name: str) -> DataFrame:
    """The table's rows without the columns of the storage."""
    return spark.table(name).drop(PART, *FINGERPRINT)


def refresh_changed(new: DataFrame, name: str, key: Sequence[str], parts: int = 64, root: str | None = None) -> dict:
    """Make table ``name`` hold exactly the rows of ``new``.

    ``key``: columns that identify a row, or nearly (they choose its
    partition). Returns {"added", "gone", "rewritten", "parts"}: rows that came
    and went, and how many of the partitions were rewritten."""
    spark = new.sparkSession
    part = F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in key]), F.lit(parts)).cast("int").alias(PART)
    columns = new.columns
    rows, copy = hand_off(with_fingerprint(new).select(*[F.col(quoted(c)) for c in columns], *FINGERPRINT, part), "changed", return_path=True)
    try:
        if not spark.catalog.tableExists(name):
            path = new_version_path(spark, name, root)
            spark.sql(f"CREATE TABLE {name} ({_ddl(rows.drop(PART).schema)}, {PART} int) USING parquet PARTITIONED BY ({PART}) LOCATION '{path}'")
        stored = spark.table(name)
        if stored.drop(PART, *FINGERPRINT).dtypes != rows.drop(PART, *FINGERPRINT).dtypes:
            raise RefreshError(f"{name}: other columns than the stored table's; table left unchanged")
        narrow = [*[F.col(quoted(k)) for k in key], *FINGERPRINT, PART]
        net = net_changes(stored.select(*narrow), rows.select(*narrow), [PART])
        found = net.groupBy(PART).agg(F.sum(F.greatest("net", F.lit(0))).alias("added"), F.sum(F.greatest(-F.col("net"), F.lit(0))).alias("gone")).collect()
        out = {"added": sum(r["added"] for r in found), "gone": sum(r["gone"] for r in found), "rewritten": len(found), "parts": parts}
        touched = [r[PART] for r in found]           # at most ``parts`` numbers
        if touched:
            _rewrite(spark, name, rows, touched, new_version_path(spark, name, root))
        return out
    finally:
        remove_path(spark, copy)


def _rewrite(spark: SparkSession, name: str, rows: DataFrame, touched: list[int], path: str) -> None:
    some = rows.where(F.col(PART).isin(touched))
    try:
        some.repartition(PART).write.partitionBy(PART).parquet(path)
        written = {r[PART]: r["n"] for r in spark.read.schema(rows.schema).parquet(path).groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        expected = {r[PART]: r["n"] for r in some.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        if written != expected:
            raise RefreshError(f"{name}: rows written differ from rows to write; table left unchanged")
    except Exception:
        remove_path(spark, path)
        raise
    had = {int(r["partition"].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for p in touched:
        if p not in expected:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PART}={p})")
        elif p in had:
            spark.sql(f"ALTER TABLE {name} PARTITION ({PART}={p}) SET LOCATION '{path}/{PART}={p}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({PART}={p}) LOCATION '{path}/{PART}={p}'")
    spark.catalog.refreshTable(name)
