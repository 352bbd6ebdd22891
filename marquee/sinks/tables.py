"""Sinks: typed table creation, append, swap-safe full refresh, hand-offs.

A full refresh never exposes an empty or half-written table: the new data is
written to a fresh versioned folder, its row count is checked against the
count observed while writing (no second pass), and only then the catalog
table is pointed at the new folder in one metadata operation. A failed write
leaves the old version in place; Spark's task retries and the output
committer make the write itself survive lost executors.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions.text import quoted
from marquee.session import scratch_root


#: File that marks a version whose row count has been checked.
CHECKED = "_CHECKED"


#: File that holds a version's buckets, for other processes.
BUCKETS = "_BUCKETS"


class RefreshError(RuntimeError):
    pass


@dataclass(frozen=True)
class Buckets:
    """Storage by hash of ``keys``: tables with equal keys and number join on
    them without a shuffle. Rows of a file are sorted by ``sort``."""

    number: int
    keys: tuple[str, ...]
    sort: tuple[str, ...] = ()

    def clause(self) -> str:
        by = ", ".join(map(quoted, self.keys))
        order = f" SORTED BY ({', '.join(map(quoted, self.sort))})" if self.sort else ""
        return f" CLUSTERED BY ({by}){order} INTO {self.number} BUCKETS"


def _ddl(schema: StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema.fields)


def create_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None,
                 fmt: str = "parquet", buckets: Buckets | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a StructType: fixed, hand-written
    types rather than inferred ones, NOT NULL where a field isn't nullable."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING {fmt}{buckets.clause() if buckets else ''}{loc}")


def stored_buckets(spark: SparkSession, name: str) -> Buckets | None:
    """The buckets that the catalog has for a table."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in told:
        return None
    columns = lambda text: tuple(c.replace("``", "`") for c in re.findall("`((?:[^`]|``)+)`", text or ""))
    return Buckets(int(told["Num Buckets"]), columns(told["Bucket Columns"]), columns(told.get("Sort Columns")))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs_path(spark, path)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_version(df: DataFrame, path: str, fmt: str, buckets: Buckets | None) -> None:
    if buckets is None:
        df.write.format(fmt).mode("errorifexists").save(path)
        return
    # one task a bucket; adaptive execution cuts a bucket that a hot key makes
    # too large into several tasks (and files) and puts small ones together
    name = f"write_{uuid.uuid4().hex}"
    w = df.hint("rebalance", buckets.number, *buckets.keys).write.format(fmt).bucketBy(buckets.number, *buckets.keys)
    try:
        (w.sortBy(*buckets.sort) if buckets.sort else w).option("path", path).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")      # external: the files stay
    _write_text(df.sparkSession, f"{path}/{BUCKETS}", json.dumps(asdict(buckets)))


def append(df: DataFrame, name: str) -> None:
    """Append by position into an existing table (partition-parallel)."""
    df.write.insertInto(name, overwrite=False)


def _same_columns(a: DataFrame, b: DataFrame) -> bool:
    return a.dtypes == b.dtypes     # names and types; files don't keep nullability


def default_root(spark: SparkSession) -> str:
    """Result tables live beside the session's warehouse, never under the
    checkpoint folder (whose content may be cleared after a run)."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/marquee"


def new_version_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{(root or default_root(spark)).rstrip('/')}/{name}/v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on the cluster's file system (HDFS, object store or
    local), recursively. Returns whether something was deleted."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def _versions(spark: SparkSession, table_dir: str) -> list[str]:
    """Version folders of one table, the oldest first; other folders are not
    looked at."""
    fs, p = _fs_path(spark, table_dir)
    if not fs.exists(p):
        return []
    found = [st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory()]
    named = [(re.fullmatch(r"v(\d+)-[0-9a-f]+", x.rstrip("/").rsplit("/", 1)[-1]), x) for x in found]
    return [x for _, x in sorted((int(m[1]), x) for m, x in named if m)]


def prune_versions(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` version folders of one table."""
    old = _versions(spark, table_dir)[:-keep] if keep >= 1 else []
    for v in old:
        remove_path(spark, v)
    return old


def attach(spark: SparkSession, names, root: str | None = None) -> list[str]:
    """Make tables that another process has written readable by name: for each
    name that the catalog doesn't know, a view of its newest checked version
    under ``root`` (a bucketed one becomes a table, so that its joins still
    need no shuffle). Returns the names found."""
    out = []
    for name in names:
        if not spark.catalog.tableExists(name):
            done = [v for v in _versions(spark, f"{(root or default_root(spark)).rstrip('/')}/{name}")
                    if _exists(spark, f"{v}/{CHECKED}")]
            if not done:
                continue
            rows = spark.read.parquet(done[-1])
            if _exists(spark, f"{done[-1]}/{BUCKETS}"):
                b = json.loads(_read_text(spark, f"{done[-1]}/{BUCKETS}"))
                create_table(spark, name, rows.schema, done[-1], buckets=Buckets(b["number"], tuple(b["keys"]), tuple(b["sort"])))
            else:
                rows.createOrReplaceTempView(name)
        out.append(name)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def full_refresh(df: DataFrame, name: str, root: str | None = None, fmt: str = "parquet",
                 expect_rows: int | None = None, keep_versions: int | None = 2,
                 schema: StructType | None = None, new_columns: bool = False, buckets: Buckets | None = None) -> dict:
    """Replace table ``name`` with ``df`` without an empty window.

    ``schema``: the fixed columns and types to load (others of ``df`` stay
    behind them). ``buckets``: store the rows by hash of a key. A frame whose
    columns or buckets differ from the stored table's is refused and the table
    stays as it is, unless ``new_columns`` allows it: the catalog entry is then
    dropped and created anew, and a reader in between finds no table.

    1. write ``df`` to a new version folder, counting rows on the way
       (``Observation``: the count comes from the write job itself);
    2. check the count (and ``expect_rows`` when given);
    3. create the table on first use, else ``ALTER TABLE ... SET LOCATION``
       and refresh cached metadata: readers switch from the old complete
       version to the new complete version.
    Returns ``{"table", "path", "rows"}``.
    """
    spark = df.sparkSession
    if schema is not None:
        fixed = {f.name: f.dataType for f in schema.fields}
        df = df.select(*[F.col(quoted(c)).cast(t).alias(c) for c, t in fixed.items()],
                       *[F.col(quoted(c)) for c in df.columns if c not in fixed])
    known = spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "TEMPORARY"
    same = known and _same_columns(spark.table(name), df) and stored_buckets(spark, name) == buckets
    if known and not same and not new_columns:
        raise RefreshError(f"{name}: other columns or buckets than the stored table's; table left unchanged")
    path = new_version_path(spark, name, root)
    obs = Observation(f"refresh_{name}_{uuid.uuid4().hex[:6]}")
    try:
        _write_version(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt, buckets)
    except Exception:
        remove_path(spark, path)        # no partial version is left to be mistaken for a good one
        raise
    rows = obs.get["rows"]
    if expect_rows is not None and rows != expect_rows:
        remove_path(spark, path)
        raise RefreshError(f"{name}: wrote {rows} rows, expected {expect_rows}; table left unchanged")
    fs, mark = _fs_path(spark, f"{path}/{CHECKED}")
    fs.create(mark).close()
    spark.catalog.dropTempView(name)        # one that ``attach`` has made
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if schema is not None:
            create_table(spark, name, StructType(list(schema.fields) + [f for f in df.schema.fields if f.name not in fixed]), path, fmt, buckets)
        elif buckets:
            create_table(spark, name, df.schema, path, fmt, buckets)
        else:
            spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if keep_versions:
        # the current and the previous complete versions stay (a reader that
        # planned against the previous one can still finish)
        prune_versions(spark, path.rsplit("/", 1)[0], keep_versions)
    return {"table": name, "path": path, "rows": rows}


def create_view(df: DataFrame, name: str) -> None:
    """Materialise as a view (a staging model): a named, lazily inlined plan
    of this session; other processes make it again from its tables."""
    df.createOrReplaceTempView(name)


def hand_off(df: DataFrame, name: str, fmt: str = "parquet", return_path: bool = False):
    """Write a stage's output to the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor recomputes from this copy, not
    from the source) and replaces the reference's local CSV hand-off.
    ``return_path=True`` also returns the folder, for ``remove_path`` once
    every consumer has run."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/handoff/{name}/{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(path)
    out = spark.read.format(fmt).load(path)
    return (out, path) if return_path else out


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               truncate: bool = True, num_partitions: int | None = None) -> None:
    """External database sink: overwrite with TRUNCATE (keeps the table's DDL)
    and one connection per partition (bounded by ``num_partitions``)."""
    w = df.coalesce(num_partitions) if num_partitions else df
    (w.write.mode("overwrite").option("truncate", truncate)
      .jdbc(url, table, properties=dict(properties or {})))
