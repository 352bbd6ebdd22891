"""Views that outlive their session.

A staging model is a view: SQL text over stored tables. ``save_view`` makes it
known to its session and keeps its text as a small file beside the tables (``<warehouse>/_views/<name>.sql``); ``open_warehouse`` makes every table
and view of a warehouse known to a new session, so a second process finds them
by name without knowing which job wrote them. ``session.get_session`` calls it
when it is given a warehouse. The files are the catalog: no metastore runs.

A view's file is written after the session took its text, so a text that
doesn't parse is never kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.sinks.tables import CHECKED, _exists, _fs_path, _read_text, _versions, _write_text, attach, default_root, remove_path

VIEWS = "_views"


def save_view(spark: SparkSession, name: str, sql: str, root: str | None = None) -> DataFrame:
    """Create or replace view ``name`` here and for later sessions."""
    root = (root or default_root(spark)).rstrip("/")
    df = spark.sql(sql)
    df.createOrReplaceTempView(name)
    remove_path(spark, f"{root}/{VIEWS}/{name}.sql")
    _write_text(spark, f"{root}/{VIEWS}/{name}.sql", sql)
    return df


def drop_view(spark: SparkSession, name: str, root: str | None = None) -> None:
    spark.catalog.dropTempView(name)
    remove_path(spark, f"{(root or default_root(spark)).rstrip('/')}/{VIEWS}/{name}.sql")


def _names(spark: SparkSession, folder: str, directories: bool) -> list[str]:
    fs, p = _fs_path(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == directories)


def open_warehouse(spark: SparkSession, root: str | None = None) -> dict[str, list[str]]:
    """Make the warehouse's tables (newest checked version) and views known.
    Views may read views: those whose inputs are missing yet are tried again."""
    root = (root or default_root(spark)).rstrip("/")
    tables = [n for n in _names(spark, root, True) if not n.startswith("_")
              and any(_exists(spark, f"{v}/{CHECKED}") for v in _versions(spark, f"{root}/{n}"))]
    attach(spark, tables, root)
    todo = {n.removesuffix(".sql"): _read_text(spark, f"{root}/{VIEWS}/{n}") for n in _names(spark, f"{root}/{VIEWS}", False) if n.endswith(".sql")}
    made: list[str] = []
    while todo:
        failed: dict[str, Exception] = {}
        for name, sql in todo.items():
            try:
                spark.sql(sql).createOrReplaceTempView(name)
                made.append(name)
            except Exception as e:
                failed[name] = e
        if len(failed) == len(todo):
            raise RuntimeError(f"views of {root} that can't be made: {sorted(failed)}") from next(iter(failed.values()))
        todo = {n: todo[n] for n in failed}
    return {"tables": tables, "views": sorted(made)}
