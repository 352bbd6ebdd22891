"""Plan shape: pruning, pushdown, join type, top-k strategy, no Python."""


from marquee.operators import marts, staging
from marquee.plans.catalog import Catalog
from marquee.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_query(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_tag_branch_prunes_money_columns(spark):
    p = plan(QUERIES["distinct_tags"](spark, SF))
    assert "l_extendedprice" not in p and "o_totalprice" not in p


def test_genre_mart_join_is_inner(spark, raw):
    from marquee.operators import clean
    titles, tags = clean.transform(raw({"title": "a", "budget": "1", "box_office": "2", "genre": "X"}))
    p = marts.genre_mart(staging.staged_titles(titles), tags)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in p and "LeftOuter" not in p


def test_top_k_is_take_ordered(spark):
    p = plan(QUERIES["roi_top5_nulls_first"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_staging_filter_reaches_stored_scan(spark, tmp_path):
    path = str(tmp_path / "titles")
    Catalog(spark, SF).titles.write.parquet(path)
    st = staging.staged_titles(spark.read.parquet(path))
    p = plan(st)
    assert "IsNotNull(box_office)" in p


def test_genre_mart_plan_has_no_cross_join(spark):
    for name in ("genre_mart", "top_titles_mart", "global_rank_titles", "reject_reasons"):
        p = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_marts_aggregate_before_every_shuffle(spark):
    p = plan(QUERIES["genre_mart"](spark, SF))
    # (title, genre) pairs and per-title sums are combined map-side
    assert "partial_count(1)" in p and "partial_sum" in p


def scans_that_ran(spark, name):
    """Rows that the query's jobs read from lineitem, by the final adaptive plan."""
    df = QUERIES[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]


def test_raw_joins_run_once(spark):
    for name in ("genre_mart", "genre_top5", "transform_summary", "reject_reasons", "report_roi_by_genre"):
        p = scans_that_ran(spark, name)
        assert p.count("lineitem.parquet") == 1, name


def test_copies_are_made_by_one_scan(spark, monkeypatch):
    """The job that checkpoints the wide rows reads lineitem once, without a
    cross join; the query reads the checkpoint."""
    from pyspark.sql.classic.dataframe import DataFrame
    plans = []
    real = DataFrame.checkpoint

    def spy(self, *a, **k):
        plans.append(plan(self))
        return real(self, *a, **k)

    monkeypatch.setattr(DataFrame, "checkpoint", spy)
    rest = plan(QUERIES["top_titles_mart"](spark, SF))
    assert len(plans) == 1 and plans[0].count("lineitem.parquet") == 1 and "lineitem" not in rest
    assert "CartesianProduct" not in plans[0] and "BroadcastNestedLoopJoin" not in plans[0]


def test_cluster_conf_sizes_shuffle_to_input():
    from marquee.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, 8, 1000)
    assert int(big["spark.sql.shuffle.partitions"]) == 51_200
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(10 * 1024 ** 2, 8, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 64      # at least two waves of cores
