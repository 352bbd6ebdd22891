"""Every registered query against its DuckDB oracle SQL on the smallest
driver tables (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from marquee.plans.oracle import ORACLE_SQL  # noqa: E402
from marquee.plans.queries import QUERIES  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) == set(ORACLE_SQL) <= set(E.oracle_sql())


def test_limits_and_rules_bite(con):
    """No top-k shows a whole group list, and every load rule rejects rows."""
    for name in ("reject_reasons", "report_genre_revenue", "tag_counts_top10", "report_countries", "country_mart"):
        rows = con.execute(ORACLE_SQL[name]).fetchall()
        if name == "reject_reasons":
            assert all(r[-1] > 0 for r in rows), rows
        elif name == "country_mart":
            ranks = [r[-1] for r in rows]
            assert len(rows) > 10 and len(set(ranks)) < len(ranks) and any(r[0] is None for r in rows)
            assert any(r[1] <= 3 for r in rows)
        else:
            assert len(rows) == 10
    assert len(con.execute(ORACLE_SQL["genre_mart"]).fetchall()) > 10
    assert all(r[-1] is not None for r in con.execute(ORACLE_SQL["roi_top5_nulls_last"]).fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "movie_count", "avg_budget", "avg_box_office", "avg_roi",
                          "total_box_office", "revenue_rank"]
    assert df.count() > 0
