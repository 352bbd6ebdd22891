"""Corpus queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from marquee.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages")


def rows(frame):
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None)
    # pandas makes floating point of integers beside nulls, on one side or on both
    whole = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    return columns, sorted(str([whole(v) for v in r]) for r in values.values.tolist())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLE_SQL[name]).df())


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
