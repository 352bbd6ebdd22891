"""Stored tables: buckets, rank order, changes only, lasting views, footers."""

import glob
import os
import random
import shutil
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.operators import audit, changes, marts
from marquee.plans.incremental import MartState
from marquee.plans.queries import QUERIES
from marquee.plans.stored import Stored
from marquee.sinks import RefreshError, attach, full_refresh
from marquee.sinks.buckets import bucket_bytes, location, read_bucketed
from marquee.sinks.changes import refresh_changed, stored_rows
from marquee.sinks.clustered import Clustered, refresh_clustered
from marquee.sinks.tables import Buckets, stored_buckets
from marquee.sinks.views import drop_view, open_warehouse, save_view
from marquee.sources.tables import read_for_counts

SF = "/root/testdata/sf0.001"


def ran(df):
    """The final adaptive plan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# buckets

def test_stored_title_join_has_no_exchange_under_it(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ran(QUERIES["top_titles_mart_stored"](spark, SF))
        assert "SortMergeJoin" in joined and "Exchange" not in joined and joined.count("Bucketed: true") == 2
        mart = ran(QUERIES["genre_mart_stored"](spark, SF))
        under = mart[mart.index("SortMergeJoin"):]
        assert "Exchange" not in under and mart.count("Bucketed: true") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def hot_rows(spark, n=3000):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("title"), F.col("id").alias("v"))


def test_hot_bucket_is_read_by_plain_splits(spark, tmp_path):
    name, b = "hot_bucket_probe", Buckets(4, ("title",), ("title",))
    full_refresh(hot_rows(spark), name, str(tmp_path), buckets=b)
    assert stored_buckets(spark, name) == b
    sizes = bucket_bytes(spark, location(spark, name))
    assert set(sizes) == {0, 1, 2, 3} and sum(sizes.values()) > 0
    even, split = read_bucketed(spark, name), read_bucketed(spark, name, most_bytes=max(sizes.values()) - 1)
    count = lambda df: df.groupBy("title").agg(F.sum("v").alias("s"))
    assert "Bucketed: true" in ran(count(even)) and "Bucketed: true" not in ran(count(split))
    assert "partial_sum" in ran(count(split)) and rows(even) == rows(split) == rows(hot_rows(spark))
    # another number of buckets is another layout
    with pytest.raises(RefreshError):
        full_refresh(hot_rows(spark), name, str(tmp_path), buckets=Buckets(2, ("title",)))
    full_refresh(hot_rows(spark, 30), name, str(tmp_path), buckets=b)
    assert spark.table(name).count() == 30 and len(glob.glob(f"{tmp_path}/{name}/v*")) == 2
    # another process gets the buckets from the version's folder
    spark.sql(f"DROP TABLE {name}")
    assert attach(spark, [name], str(tmp_path)) == [name]
    assert stored_buckets(spark, name) == b and rows(spark.table(name)) == rows(hot_rows(spark, 30))
    spark.sql(f"DROP TABLE {name}")


def test_failed_bucketed_write_leaves_no_trace(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception):
        full_refresh(hot_rows(spark).select("title", F.raise_error(F.lit("x")).cast("long").alias("v")), "bad_buckets", str(tmp_path), buckets=Buckets(2, ("title",)))
    assert {t.name for t in spark.catalog.listTables()} == before and not glob.glob(f"{tmp_path}/bad_buckets/v*")


# rank order

ORDER = (("v", "desc"), ("k", "asc"))


def test_top_opens_only_the_first_folders(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("long").alias("v"), F.col("id").alias("k"))
    c = Clustered(spark, refresh_clustered(spark, df, "ranked", ORDER, 8, str(tmp_path)), ORDER)
    expected = [tuple(r) for r in df.orderBy(F.col("v").desc(), "k").collect()]
    assert [tuple(r) for r in c.sorted().collect()] == expected and rows(c.all()) == rows(df)
    for k in (1, 10, 900, 5000):
        assert [tuple(r) for r in c.top(k).collect()] == expected[:k]
    folders = c.ranges.collect()
    assert len(folders) == 8 and sum(r["rows"] for r in folders) == 4000
    assert max(r["rows"] for r in folders) < 1500             # the value of a third of the rows is spread
    assert metric(c.top(10), "numFiles") == 1 and metric(c.all(), "numFiles") == 8
    assert rows(c.at_least(98)) == [r for r in sorted(expected, key=repr) if r[0] >= 98]
    assert metric(c.at_least(98), "numFiles") < 8 and rows(c.at_least(1000)) == []


def metric(df, name):
    """A figure of the only scan of a plan that ran."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage", "BroadcastQueryStage", "TableCacheQueryStage")):
            node = node.plan()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply(name).value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    assert len(found) == 1
    return found[0]


def test_clustered_edge_cases(spark, tmp_path):
    empty = spark.createDataFrame([], "v long, k long")
    c = Clustered(spark, refresh_clustered(spark, empty, "none", ORDER, 4, str(tmp_path)), ORDER)
    assert c.top(5).collect() == []
    nulls = spark.createDataFrame([(None, 1), (5, 2), (None, 0), (5, 2)], "v long, k long")
    c = Clustered(spark, refresh_clustered(spark, nulls, "nulls", ORDER, 4, str(tmp_path)), ORDER)
    assert [tuple(r) for r in c.sorted().collect()] == [(5, 2), (5, 2), (None, 0), (None, 1)]
    assert [tuple(r) for r in c.top(3).collect()] == [(5, 2), (5, 2), (None, 0)]
    with pytest.raises(Exception):
        refresh_clustered(spark, nulls.select(F.raise_error(F.lit("x")).cast("long").alias("v"), "k"), "bad", ORDER, 4, str(tmp_path))
    assert not glob.glob(f"{tmp_path}/bad/v*")
    with pytest.raises(FileNotFoundError):
        Clustered(spark, str(tmp_path / "nulls"), ORDER)


def test_stored_top10_reads_less(spark):
    stored = Stored.of(spark, SF)
    assert metric(stored.top_titles.top(10), "numFiles") < metric(stored.top_titles.all(), "numFiles")


# changes

def versions(seed, n=200):
    rng = random.Random(seed)
    some = [(rng.choice([None, *range(n // 2)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 1, 2])) for _ in range(n)]
    old = some + rng.choices(some, k=n // 4)
    new = rng.sample(old, len(old) * 3 // 4) + [(k, s, (v or 0) + 1) for k, s, v in rng.sample(some, n // 5)] + rng.choices(some, k=5)
    return old, new


SCHEMA = "k long, s string, v int"


@pytest.mark.parametrize("seed", range(4))
def test_diff_is_that_of_multisets(spark, seed):
    old, new = versions(seed)
    o, n = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    net = Counter(new)
    net.subtract(Counter(old))
    weights = Counter({r: w for r, w in net.items() if w})
    got = Counter()
    for r in changes.signed_rows(o, n, ("k",)).collect():
        got[tuple(r)[:-1]] += r["weight"]
    assert got == weights
    per_key = {}
    for (k, _, _), w in weights.items():
        g, a = per_key.get(k, (0, 0))
        per_key[k] = (g + max(-w, 0), a + max(w, 0))
    expected = [(k, "added" if not g else "gone" if not a else "changed", g, a) for k, (g, a) in per_key.items()]
    assert rows(changes.diff(o, n, ("k",))) == sorted(expected, key=repr)
    assert changes.diff(o, o, ("k",)).collect() == []


def test_only_changed_partitions_are_rewritten(spark, tmp_path):
    name, root = "changes_probe", str(tmp_path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    base = spark.range(500).select("id", (F.col("id") * 2).alias("v"))
    base = base.unionByName(base.where("id < 5"))           # repeated rows
    first = refresh_changed(base, name, ("id",), parts=16, root=root)
    assert first == {"added": 505, "gone": 0, "rewritten": 16, "parts": 16}
    files = set(spark.table(name).inputFiles())
    assert refresh_changed(base, name, ("id",), parts=16, root=root)["rewritten"] == 0
    assert set(spark.table(name).inputFiles()) == files
    one = base.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    assert refresh_changed(one, name, ("id",), parts=16, root=root) == {"added": 1, "gone": 1, "rewritten": 1, "parts": 16}
    assert rows(stored_rows(spark, name)) == rows(one)
    assert len(files - set(spark.table(name).inputFiles())) == 1
    # one copy fewer of a repeated row is a change
    assert refresh_changed(one.dropDuplicates(), name, ("id",), parts=16, root=root)["gone"] == 5
    # a partition that runs empty goes
    few = spark.createDataFrame([(3, 6)], "id long, v long")
    assert refresh_changed(few, name, ("id",), parts=16, root=root)["gone"] == 499
    assert rows(stored_rows(spark, name)) == [(3, 6)]
    assert refresh_changed(base, name, ("id",), parts=16, root=root)["added"] == 504
    assert rows(stored_rows(spark, name)) == rows(base)
    # failed writes and other columns change nothing
    with pytest.raises(Exception):
        refresh_changed(base.withColumn("v", F.raise_error(F.lit("x")).cast("long")), name, ("id",), parts=16, root=root)
    with pytest.raises(RefreshError):
        refresh_changed(base.withColumn("w", F.lit(1)), name, ("id",), parts=16, root=root)
    assert rows(stored_rows(spark, name)) == rows(base)
    spark.sql(f"DROP TABLE {name}")


# batches

T = "title string, country string, budget long, box_office long, roi decimal(10,2)"
G = "title string, genre string"


def batch_rows(rng, n):
    titles = [("hot" if rng.random() < 0.3 else rng.choice([None, *"abcdefghij"]), rng.choice([None, "x", "y"]), rng.choice([None, 0, 7, 10 ** 12]),
               rng.choice([None, 5, 6, -3]), rng.choice([None, "1.25", "-3.10"])) for _ in range(n)]
    tags = [("hot" if rng.random() < 0.3 else rng.choice([None, *"abcdefghijk"]), rng.choice([None, "g1", "g2", "g3"])) for _ in range(n)]
    return titles, tags


def frames(spark, titles, tags):
    t = spark.createDataFrame(titles, T.replace("roi decimal(10,2)", "roi string")).withColumn("roi", F.col("roi").cast("decimal(10,2)"))
    return t, spark.createDataFrame(tags, G)


def full(spark, titles, tags):
    t, g = frames(spark, titles, tags)
    staged = t.where("box_office IS NOT NULL")
    return rows(marts.genre_mart(staged, g, "window")), rows(marts.country_mart(staged, "window"))


@pytest.mark.parametrize("seed", range(2))
def test_batches_equal_one_full_run(spark, tmp_path, seed):
    """Titles repeat across batches; a batch runs twice; rows are withdrawn."""
    rng = random.Random(seed)
    state = MartState(spark, str(tmp_path / "state"))
    with pytest.raises(FileNotFoundError):
        state.genre_mart()
    titles, tags = [], []
    for b in range(1, 4):
        more_t, more_g = batch_rows(rng, 40)
        state.add(b, *frames(spark, more_t, more_g))
        titles, tags = titles + more_t, tags + more_g
        assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, titles, tags)
    state.add(3, *frames(spark, more_t, more_g))        # once more
    assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, titles, tags)
    # a correction: some rows go, others come in their place
    new_t = titles[10:] + [(t, "z", 1, 2, "0.01") for t, *_ in titles[:10]]
    new_g = tags[25:]
    o, n = frames(spark, titles, tags), frames(spark, new_t, new_g)
    state.add(4, changes.signed_rows(o[0], n[0], ("title",)), changes.signed_rows(o[1], n[1], ("title",)))
    assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, new_t, new_g)
    assert state.compact() == 1 and state.batches() == [4]
    assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, new_t, new_g)
    with pytest.raises(ValueError):
        state.add(4, *frames(spark, more_t, more_g))        # folded
    more_t, more_g = batch_rows(rng, 20)
    state.add(5, *frames(spark, more_t, more_g))
    assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, new_t + more_t, new_g + more_g)
    with pytest.raises(ValueError):
        state.add(2, *frames(spark, more_t, more_g))


def test_a_batch_of_titles_is_read_once(spark, tmp_path):
    """All title parts come from one pass; a batch that changes only tags leaves the rest as it is."""
    titles = [("A", "x", 1, 10, "0.01"), ("A", "x", 1, 10, "0.01"), ("B", None, None, 20, None), (None, "y", 3, 30, "1.50"), ("C", "y", 4, None, "2.00")]
    tags = [("A", "g"), ("A", "g"), ("A", "h"), ("B", None), ("C", "g"), (None, "g"), ("D", "h")]
    read = spark.sparkContext.accumulator(0)

    def counted(r):
        read.add(1)
        return r

    t, g = frames(spark, titles, tags[:3])
    state = MartState(spark, str(tmp_path / "state"))
    state.add(1, spark.createDataFrame(t.rdd.map(counted), t.schema), g)
    assert read.value == len(titles)
    state.add(2, t.limit(0), frames(spark, titles, tags[3:])[1])
    assert (rows(state.genre_mart()), rows(state.country_mart())) == full(spark, titles, tags)


HEADER = "title,release_year,director,language,country,duration,budget,box_office,genre\n"


def test_two_csv_batches_equal_one_run(spark, tmp_path):
    """Raw batches through cleaning, load rules and stored sums; titles repeat across batches."""
    from marquee.plans.pipeline import run_batch, run_pipeline
    from marquee.sources import read_raw_csv
    first = 'A,2001,D1,en,US,90,100,300,"Action, Horor"\nB,2002,D2,en,UK,95.5,200,unknown,Drama\nA,2001,D1,en,US,90,100,300,"Action, Horor"\n'
    second = 'C,2003,D3,en,US,100,0,50,"Drama,,Action"\nNone,2004,D4,en,US,80,10,20,Comedy\nA,2009,D5,fr,FR,80,10,20,Comedy\n'
    for name, text in (("one", first), ("two", second), ("all", first + second)):
        (tmp_path / f"{name}.csv").write_text(HEADER + text)
    read = lambda name: read_raw_csv(spark, str(tmp_path / f"{name}.csv"))
    run_pipeline(spark, read("all"), root=str(tmp_path / "wh"), prefix="whole_")
    run_batch(spark, read("one"), 1, root=str(tmp_path / "wh"), prefix="parts_")
    for _ in range(2):          # the second batch runs twice
        out = run_batch(spark, read("two"), 2, root=str(tmp_path / "wh"), prefix="parts_")
    assert out["movies_rejects"] == 1 and out["movie_genres_rejects"] == 2
    for t in ("mart_genre_analysis", "mart_country_analysis", "mart_top_movies"):
        assert rows(spark.table(f"parts_{t}")) == rows(spark.table(f"whole_{t}").select(*spark.table(f"parts_{t}").columns)), t


def test_links_are_checked_on_load(spark, tmp_path):
    """Tags of a title that a load rule rejects are orphans."""
    from marquee.plans.pipeline import run_pipeline
    from marquee.sources import read_raw_csv
    (tmp_path / "a.csv").write_text(HEADER + f'A,2001,D,en,US,90,100,300,"Action,Drama"\nB,2001,{"d" * 201},en,US,90,100,300,"Action,Drama"\n')
    raw = read_raw_csv(spark, str(tmp_path / "a.csv"))
    loose = run_pipeline(spark, raw, root=str(tmp_path / "wh"), prefix="loose_")
    tight = run_pipeline(spark, raw, root=str(tmp_path / "wh"), prefix="tight_", check_links=True)
    assert (loose["movie_genres"], loose["movie_genres_rejects"], tight["movie_genres"], tight["movie_genres_rejects"]) == (4, 0, 2, 2)
    assert {r["reason"] for r in spark.table("tight_movie_genres_rejects").collect()} == {"title_not_found"}


def test_interrupted_folding_is_taken_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    state = MartState(spark, path)
    t, g = frames(spark, [("a", "x", 1, 2, "1.00")], [("a", "g")])
    for b in (1, 2):
        state.add(b, t, g)
    expected = rows(state.genre_mart())
    monkeypatch.setattr(MartState, "_take_compacted", lambda self: None)
    state.compact()                                         # stopped after the folded parts were written
    assert state.batches() == [1, 2] and rows(state.genre_mart()) == expected
    os.rename(f"{path}/_compact/rows", f"{path}/moved")     # and after one of them had taken its place
    shutil.copytree(f"{path}/moved", f"{path}/folded")
    for name in os.listdir(f"{path}/rows"):
        os.rename(f"{path}/rows/{name}", f"{tmp_path}/old-{name}")
    for name in os.listdir(f"{path}/folded"):
        os.rename(f"{path}/folded/{name}", f"{path}/rows/{name}")
    monkeypatch.undo()
    again = MartState(spark, path)
    assert again.batches() == [2] and rows(again.genre_mart()) == expected and not os.path.exists(f"{path}/_compact")
    assert spark.read.parquet(f"{path}/rows/00000002").collect()[0]["copies"] == 2


def test_everything_withdrawn_leaves_empty_marts(spark, tmp_path):
    state = MartState(spark, str(tmp_path / "state"))
    t, g = frames(spark, [("a", "x", 1, 2, "1.00")] * 2, [("a", "g")] * 3)
    state.add(1, t, g)
    state.add(2, t.withColumn("weight", F.lit(-1)), g.limit(0))
    assert state.genre_mart().collect() == state.country_mart().collect() == []


def test_a_batch_reads_only_partial_sums(spark, tmp_path):
    """The state holds a title of 3,000 rows once a batch."""
    state = MartState(spark, str(tmp_path / "state"))
    t, g = frames(spark, [("hot", "x", 1, 2, "1.00")] * 3000, [("hot", "g")] * 3000)
    for b in (1, 2):
        state.add(b, t, g)
    for part, n in (("titles", 1), ("tags", 1), ("countries", 1), ("genres", 1)):
        assert spark.read.parquet(f"{state.path}/{part}/00000002").count() == n
    r = state.genre_mart().first()
    assert (r["movie_count"], r["total_box_office"]) == (1, 6000 * 6000 * 2)


# lasting views

def test_views_are_seen_by_a_second_process(spark, tmp_path):
    root = str(tmp_path / "wh")
    full_refresh(spark.createDataFrame([("a", 1), ("b", None)], "title string, box_office long"), "vw_movies", root)
    save_view(spark, "vw_stg", "SELECT title FROM vw_movies WHERE box_office IS NOT NULL", root)
    save_view(spark, "vw_again", "SELECT upper(title) AS t FROM vw_stg", root)     # a view of a view
    with pytest.raises(Exception):
        save_view(spark, "vw_bad", "SELECT nothing FROM nowhere", root)
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"from marquee import get_session\ns = get_session('local[2]', warehouse={root!r})\n"
            "print('got', [tuple(r) for r in s.table('vw_again').collect()], s.table('vw_movies').count())")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": here}, capture_output=True, text=True, timeout=300)
    assert "got [('A',)] 2" in done.stdout, done.stderr[-2000:]
    for v in ("vw_again", "vw_stg"):
        drop_view(spark, v, root)
    assert open_warehouse(spark, root)["views"] == []
    spark.sql("DROP TABLE vw_movies")


def test_view_of_a_missing_table_is_an_error(spark, tmp_path):
    root = str(tmp_path / "wh")
    full_refresh(spark.range(1), "vw_gone", root)
    save_view(spark, "vw_of_gone", "SELECT * FROM vw_gone", root)
    spark.sql("DROP TABLE vw_gone")
    spark.catalog.dropTempView("vw_of_gone")
    shutil.copytree(f"{root}/_views", tmp_path / "other" / "_views")
    with pytest.raises(RuntimeError):
        open_warehouse(spark, str(tmp_path / "other"))


# counts

def test_counts_come_from_the_footers(spark):
    df = QUERIES["row_counts_stored"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "title#" not in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_counts_of_an_empty_and_a_bucketed_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0).write.parquet(path)
    assert audit.footer_row_counts(t=read_for_counts(spark, path)).collect()[0]["row_count"] == 0
    spark.range(10).repartition(3).write.mode("overwrite").parquet(path)
    df = read_for_counts(spark, path).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    assert tuple(df.first()) == (10, 0, 9)
