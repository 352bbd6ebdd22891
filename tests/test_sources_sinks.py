"""CSV source edge cases, swap-safe refresh, the end-to-end pipeline and the
streaming ingest."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import audit, clean, marts, staging
from marquee.plans.pipeline import load_marts, run_pipeline
from marquee.sinks import RefreshError, full_refresh
from marquee.sources import read_raw_csv
from marquee.streaming import stream_clean

HEADER = "title,release_year,director,language,country,duration,budget,box_office,genre\n"


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_quoted_title_with_quotes_and_newline(spark, tmp_path):
    p = write(tmp_path / "a.csv", HEADER + '"The ""Big""\nOne",2001,D,en,US,100,10,20,"Drama, Horor"\n')
    df = read_raw_csv(spark, str(p))
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0].title == 'The "Big"\nOne'
    assert [r.genre for r in clean.normalize_tags(df).collect()] == ["Drama", "Horror"]


def test_extract_reads_key_under_location(spark, tmp_path):
    from marquee.sources import extract_csv
    write(tmp_path / "movies.csv", HEADER + "A,2001,D,en,US,90,1,2,Drama\n")
    assert [r.title for r in extract_csv(spark, str(tmp_path)).collect()] == ["A"]


def test_null_tokens_on_read(spark, tmp_path):
    p = write(tmp_path / "b.csv", HEADER + "None,NA,N/A,,n/a,nan,NULL,unknown,\n")
    r = read_raw_csv(spark, str(p)).collect()[0]
    assert all(v is None for k, v in r.asDict().items() if k != "box_office")
    assert r.box_office == "unknown"


def test_header_only_csv_gives_empty_typed_frames(spark, tmp_path):
    p = write(tmp_path / "c.csv", HEADER)
    raw = read_raw_csv(spark, str(p), columns=HEADER.strip().split(","))
    titles, tags = clean.transform(raw)
    assert titles.count() == 0 and tags.count() == 0
    assert dict(titles.dtypes)["roi"] == "decimal(10,2)"
    assert dict(titles.dtypes)["budget"] == "bigint"


def test_full_refresh_swaps_and_never_empties(spark, tmp_path):
    root = str(tmp_path / "tables")
    name = "refresh_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    a = full_refresh(spark.range(5).withColumnRenamed("id", "x"), name, root)
    assert spark.table(name).count() == 5
    b = full_refresh(spark.range(7).withColumnRenamed("id", "x"), name, root)
    assert a["path"] != b["path"] and spark.table(name).count() == 7
    # a failing write leaves the previous version readable
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception):
        full_refresh(bad, name, root)
    assert spark.table(name).count() == 7
    # a count check failure also leaves the table unchanged
    with pytest.raises(RefreshError):
        full_refresh(spark.range(2).withColumnRenamed("id", "x"), name, root, expect_rows=3)
    assert spark.table(name).count() == 7
    assert len(glob.glob(f"{root}/{name}/v*")) == 2      # failed attempts left no folder
    # older complete versions beyond the newest two are deleted after a swap
    full_refresh(spark.range(7).withColumnRenamed("id", "x"), name, root)
    assert len(glob.glob(f"{root}/{name}/v*")) == 2
    assert spark.table(name).count() == 7
    # folders of others beside the versions are left alone
    os.makedirs(f"{root}/{name}/views-of-mine")
    full_refresh(spark.range(7).withColumnRenamed("id", "x"), name, root)
    assert os.path.isdir(f"{root}/{name}/views-of-mine")
    # other columns are refused, and taken only when asked to
    other = spark.range(2).select(F.col("id").alias("x"), F.lit("a").alias("y"))
    with pytest.raises(RefreshError):
        full_refresh(other, name, root)
    assert spark.table(name).columns == ["x"] and spark.table(name).count() == 7
    full_refresh(other, name, root, new_columns=True)
    assert spark.table(name).columns == ["x", "y"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_pipeline_end_to_end_is_idempotent(spark, tmp_path):
    p = write(tmp_path / "films.csv", HEADER
              + "A,2001,D1,en,US,90,100,300,\"Action, Horor\"\n"
              + "B,2002,D2,en,UK,95.5,200,unknown,Drama\n"
              + "C,2003,D3,en,US,100,0,50,\"Drama,,Action\"\n"
              + "None,2004,D4,en,US,80,10,20,Comedy\n")
    raw = read_raw_csv(spark, str(p))
    root = str(tmp_path / "wh")
    first = run_pipeline(spark, raw, root=root, prefix="t_")
    second = run_pipeline(spark, raw, root=root, prefix="t_")
    assert first == second
    assert first["movies"] == 3 and first["movies_rejects"] == 1
    # genre rows: Action, Horror, Drama, Drama, '', Action, Comedy; '' and the None-title row rejected
    assert first["movie_genres"] == 5 and first["movie_genres_rejects"] == 2
    m = load_marts(spark, "t_")
    genres = {r.genre: r.movie_count for r in m["genres"].collect()}
    assert genres == {"Action": 2, "Horror": 1, "Drama": 1}
    assert [r.title for r in m["movies"].collect()] == ["A", "C"]


def test_streaming_ingest_matches_batch(spark, tmp_path):
    src = tmp_path / "drops"
    os.makedirs(src)
    write(src / "m1.csv", HEADER + "A,2001,D1,en,US,90,100,300,\"Action, Horor\"\n")
    write(src / "m2.csv", HEADER + "B,2002,D2,en,UK,95,200,400,Drama\n")
    out = str(tmp_path / "out")
    q = stream_clean(spark, str(src), HEADER.strip().split(","), out, str(tmp_path / "ck"))
    q.awaitTermination(120)
    titles = spark.read.parquet(f"{out}/movies")
    tags = spark.read.parquet(f"{out}/movie_genres")
    assert sorted(r.title for r in titles.collect()) == ["A", "B"]
    assert sorted(r.genre for r in tags.collect()) == ["Action", "Drama", "Horror"]
    # a restart on the same checkpoint processes only new files
    write(src / "m3.csv", HEADER + "C,2003,D3,en,FR,80,10,20,Comedy\n")
    q2 = stream_clean(spark, str(src), HEADER.strip().split(","), out, str(tmp_path / "ck"))
    q2.awaitTermination(120)
    titles = spark.read.parquet(f"{out}/movies")
    assert sorted(r.title for r in titles.collect()) == ["A", "B", "C"]


def test_pipeline_on_driver_tables_equals_queries(spark, tmp_path):
    from marquee.plans.catalog import DEFAULT, KEY, Catalog
    sf = "/root/testdata/sf0.001"
    c = Catalog(spark, sf)
    counts = run_pipeline(spark, c.raw, DEFAULT.corrections, DEFAULT.budget_cuts, DEFAULT.roi_cuts,
                          root=str(tmp_path / "wh"), prefix="d_", keep=(KEY,))
    assert counts["movies"] + counts["movies_rejects"] == c.titles.count() and counts["movies_rejects"] > 0
    assert counts["movie_genres"] + counts["movie_genres_rejects"] == c.tags.count()
    # the marts are those of the rows that pass the load rules
    good = spark.table("d_movies"), spark.table("d_movie_genres")
    staged = staging.staged_titles(good[0], DEFAULT.budget_cuts, DEFAULT.roi_cuts)
    for table, q in (("d_mart_genre_analysis", marts.genre_mart(staged, good[1])), ("d_mart_country_analysis", marts.country_mart(staged)),
                     ("d_mart_top_movies", marts.top_titles_compact(staged, good[1], keep=(KEY,)))):
        got = spark.table(table)
        assert sorted(got.columns) == sorted(q.columns)
        assert sorted(map(tuple, got.select(*q.columns).collect()), key=repr) == \
            sorted(map(tuple, q.collect()), key=repr)


def test_one_pass_mart_equals_the_joined_one(spark):
    from marquee.plans.catalog import Catalog
    c = Catalog(spark, "/root/testdata/sf0.001")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(marts.genre_mart(c.staged, c.tags)) == rows(c.genre_mart())
    assert rows(audit.reject_reasons(c.titles_audit, c.tags)) == rows(audit.reject_reasons_one_pass(Catalog(spark, "/root/testdata/sf0.001").wide))
    assert rows(audit.transform_summary(c.titles, c.tags)) == rows(audit.transform_summary_one_pass(c.wide))


def test_commands_as_processes_of_their_own(tmp_path):
    import subprocess
    import sys
    p = write(tmp_path / "films.csv", HEADER + "A,2001,D1,en,US,90,100,300,\"Action, Horor\"\n" + "B,2002,D2,en,US,95,200,400,Drama\n")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

    def call(*args):
        done = subprocess.run([sys.executable, "-m", "marquee", "--master", "local[2]", "--warehouse", str(tmp_path / "wh"), *args],
                              cwd=tmp_path, env=os.environ | {"PYTHONPATH": here}, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    assert '"movies": 2' in call("run", str(p))
    assert "('A', 2001" in call("verify")
    call("reports", str(tmp_path / "rep"))
    assert any(f.endswith(".csv") for f in os.listdir(tmp_path / "rep" / "03_top_movies"))


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    from marquee import session

    class Context:
        master, applicationId = "spark://host:7077", "none"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_csv_header_order_and_dotted_columns(spark, tmp_path):
    folder = tmp_path / "in"
    os.makedirs(folder)
    write(folder / "a.csv", "title,genre,imdb.score\nA,Drama,7.1\n")
    raw = read_raw_csv(spark, str(folder))
    full = raw.select("*", *[F.lit("1").alias(c) for c in clean.TITLE_COLUMNS if c not in ("title", "roi")])
    out = clean.clean_titles(full)
    assert out.columns[-1] == "imdb.score" and out.collect()[0][-1] == "7.1"
    assert staging.staged_titles(out).count() == 1
    write(folder / "b.csv", "genre,title,imdb.score\nDrama,B,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(folder)).collect()


def test_command_line_run_verify_reports(spark, tmp_path, capsys):
    from marquee.__main__ import main
    p = write(tmp_path / "films.csv", HEADER
              + "A,2001,D1,en,US,90,100,300,\"Action, Horor\"\n"
              + "B,2002,D2,en,US,95,200,400,Drama\n")
    common = ["--prefix", "cli_", "--warehouse", str(tmp_path / "wh")]
    main([*common, "run", str(p), "--rank", "global", "--columns", HEADER.strip()])
    main([*common, "verify"])
    main([*common, "reports", str(tmp_path / "rep")])
    out = capsys.readouterr().out
    assert '"movies": 2' in out and "--- tag_counts_top10 ---" in out
    top = spark.read.option("header", True).csv(str(tmp_path / "rep" / "03_top_movies"))
    assert [r.title for r in top.orderBy(F.col("box_office").cast("long").desc()).collect()] == ["B", "A"]


def test_create_table_and_append(spark, tmp_path):
    from marquee.schema import MOVIE_GENRES
    from marquee.sinks import append, create_table
    spark.sql("DROP TABLE IF EXISTS ct_movie_genres")
    create_table(spark, "ct_movie_genres", MOVIE_GENRES, str(tmp_path / "mg"))
    create_table(spark, "ct_movie_genres", MOVIE_GENRES, str(tmp_path / "mg"))   # IF NOT EXISTS
    append(spark.createDataFrame([("A", "Drama"), ("A", "Action")], "title string, genre string"),
           "ct_movie_genres")
    append(spark.createDataFrame([("B", "Drama")], "title string, genre string"), "ct_movie_genres")
    rows = sorted(map(tuple, spark.table("ct_movie_genres").collect()))
    assert rows == [("A", "Action"), ("A", "Drama"), ("B", "Drama")]
    assert spark.table("ct_movie_genres").columns == ["title", "genre"]
    spark.sql("DROP TABLE IF EXISTS ct_movie_genres")
