"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one runs over the whole driver tables through the catalogue chain.
Result column names match ``marquee.plans.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marquee import schema
from marquee.operators import audit, changes, clean, inference, links, marts, reports, sketches, staging, verify
from marquee.operators.ranking import global_rank
from marquee.plans import catalog as C
from marquee.plans.catalog import Catalog
from marquee.plans.pipeline import load_marts
from marquee.plans.stored import Stored, older
from marquee.session import scratch_root
from marquee.sinks.changes import refresh_changed, stored_rows
from marquee.sinks.tables import append, create_table, create_view, full_refresh, hand_off
from marquee.sources.csv import read_raw_csv
from marquee.sources.tables import read_for_counts

Query = Callable[[SparkSession, str], DataFrame]


# Each query reads the raw joins once: the genre mart, the summary and the
# reject counts derive everything from one wide row; the top-titles queries
# checkpoint the wide rows (titles and their tag list), as their titles and
# their tag counts meet again in a join.

def _both(spark, root):
    return Catalog(spark, root, materialize=True)


def _light(spark, root):
    return Catalog(spark, root)


def _titles_and_tags(spark, root):
    c = _light(spark, root)
    return c.titles, c.tags


def q_raw_catalog(spark, root):
    return Catalog(spark, root).raw


def q_clean_titles(spark, root):
    return Catalog(spark, root).titles


def q_normalized_tags(spark, root):
    return Catalog(spark, root).tags


def q_staged_titles(spark, root):
    return Catalog(spark, root).staged


# The marts' plain form is one window over all groups; what is stored and what
# the library gives by default is ranked by range (the *_global_rank keys).

def q_genre_mart(spark, root):
    return _light(spark, root).genre_mart("window")


def q_country_mart(spark, root):
    return Catalog(spark, root).country_mart("window")


def q_top_titles_mart(spark, root):
    return _both(spark, root).top_titles_mart


def q_ordered_tag_string(spark, root):
    return Catalog(spark, root).ordered_tag_string


def q_tag_counts_top10(spark, root):
    return verify.tag_counts_top(Catalog(spark, root).tags, 10)


def q_roi_top5_nulls_first(spark, root):
    return verify.roi_top(Catalog(spark, root).titles, 5, nulls="first", tie=C.KEY)


def q_roi_top5_nulls_last(spark, root):
    return verify.roi_top(Catalog(spark, root).titles, 5, nulls="last", tie=C.KEY)


def q_genre_top5(spark, root):
    return verify.mart_top(_light(spark, root).genre_mart("window"), "genre", 5)


def q_country_top5(spark, root):
    return verify.mart_top(Catalog(spark, root).country_mart("window"), "country", 5)


def q_row_counts(spark, root):
    t, g = _titles_and_tags(spark, root)
    return audit.row_counts(movies=t, movie_genres=g)


def q_null_audit(spark, root):
    return audit.null_audit(Catalog(spark, root).titles)


def q_transform_summary(spark, root):
    return audit.transform_summary_one_pass(_light(spark, root).wide)


def q_duplicate_titles(spark, root):
    return audit.duplicate_titles(Catalog(spark, root).titles)


def q_distinct_tags(spark, root):
    return audit.distinct_values(Catalog(spark, root).tags, "genre").orderBy("genre")


def q_reject_reasons(spark, root):
    return audit.reject_reasons_one_pass(_light(spark, root).wide)


def q_report_genre_revenue(spark, root):
    return reports.genre_revenue(_light(spark, root).genre_mart("window"), 10)


def q_report_budget_vs_revenue(spark, root):
    return reports.budget_vs_revenue(_light(spark, root).top_titles_mart, keep=(C.KEY,))


def q_report_top_titles(spark, root):
    return reports.top_titles(_light(spark, root).top_titles_mart, 10, tie=C.KEY)


def q_report_countries(spark, root):
    return reports.countries(Catalog(spark, root).country_mart("window"), 3, 10)


def q_report_roi_by_genre(spark, root):
    return reports.roi_by_tag(_light(spark, root).genre_mart("window")).orderBy(F.col("avg_roi").asc(), F.col("genre").asc())


# Scale variants of operators above: same results, so they share the oracle
# SQL of the plain query and the gate checks the scalable code paths too.

def q_genre_mart_global_rank(spark, root):
    return _light(spark, root).genre_mart("global")


def q_country_mart_global_rank(spark, root):
    return Catalog(spark, root).country_mart("global")


def q_top_titles_mart_salted(spark, root):
    c = _both(spark, root)
    return marts.top_titles_mart(c.staged, c.tags, keep=(C.KEY,), salts=4)


def q_top_titles_compact(spark, root):
    """The stored form of the mart; counts as text, as 'tag:n' in order."""
    c = _both(spark, root)
    text = F.array_join(F.transform("tag_counts", lambda p: F.concat_ws(":", p["tag"], p["n"].cast("string"))), ", ")
    return (marts.top_titles_compact(c.staged, c.tags, keep=(C.KEY,)).withColumn("genre_counts", text).drop("tag_counts"))


def q_normalized_tags_dictionary_table(spark, root):
    c = _light(spark, root)
    d = spark.createDataFrame(list(c.p.corrections.items()), "src string, dst string")
    return clean.normalize_tags_with_table(c.raw, d, key=(C.KEY,))


def q_global_rank_titles(spark, root):
    s = Catalog(spark, root).staged.select(C.KEY, "title", "box_office")
    # keys and rows both read one checkpoint of the staged rows
    return global_rank(s, "box_office", "box_office_rank", stage_input=True)


# Sources and sinks: written to the application's scratch folder and read back.

def _new_name() -> str:
    return f"q_{uuid.uuid4().hex}"


def _read_back(spark, name, *columns):
    """The table's rows; its catalog entry goes (the data is external)."""
    df = spark.table(name).select(*columns)
    spark.sql(f"DROP TABLE {name}")
    return df


def q_csv_round_trip(spark, root):
    raw = Catalog(spark, root).raw
    path = f"{scratch_root(spark)}/csv/{_new_name()}"
    (raw.write.option("header", True).option("escape", '"').option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = read_raw_csv(spark, path, columns=raw.columns)
    return back.withColumn(C.KEY, F.col(C.KEY).cast("bigint"))


def q_refresh_movies(spark, root):
    """A first load, then a swap to a second version."""
    titles, name = Catalog(spark, root).titles, _new_name()
    fixed = StructType([titles.schema[C.KEY], *schema.MOVIES.fields])
    nullable = StructType([StructField(f.name, f.dataType) for f in fixed.fields])      # rejects are not taken out here
    loaded = full_refresh(titles, name, scratch_root(spark), schema=nullable)
    full_refresh(spark.table(name), name, scratch_root(spark), expect_rows=loaded["rows"], schema=nullable, keep_versions=1)
    return _read_back(spark, name, *nullable.names)


def q_refresh_movie_genres(spark, root):
    tags, name = Catalog(spark, root).tags, _new_name()
    full_refresh(tags, name, scratch_root(spark))
    return _read_back(spark, name, *tags.columns)


def q_append_movie_genres(spark, root):
    tags, name = Catalog(spark, root).tags, _new_name()
    create_table(spark, name, tags.schema, f"{scratch_root(spark)}/append/{name}")
    append(tags, name)
    return _read_back(spark, name, *tags.columns)


def q_view_stg_movies(spark, root):
    name = _new_name()
    create_view(Catalog(spark, root).staged, name)
    df = spark.table(name)
    spark.catalog.dropTempView(name)
    return df


def q_hand_off_titles(spark, root):
    """A step's output, handed to the next step."""
    return hand_off(Catalog(spark, root).titles, "titles")


# Stored tables: titles and tags bucketed by title, marts as tables, the
# top-titles mart in rank order (``plans.stored``; written when first asked for).

def q_genre_mart_stored(spark, root):
    """The title join without a shuffle under it."""
    s = Stored.of(spark, root)
    return marts.genre_mart(s.staged(), staging.staged_tags(s.tags()), "window")


def q_top_titles_mart_stored(spark, root):
    s = Stored.of(spark, root)
    return marts.top_titles_mart(s.staged(), s.tags(), keep=(C.KEY,))


def q_staged_tags(spark, root):
    return staging.staged_tags(Stored.of(spark, root).tags())


def _mart_reads(spark, root):
    s = Stored.of(spark, root)
    return s, s.genre_mart, s.country_mart


def q_genre_mart_read(spark, root):
    s, name, _ = _mart_reads(spark, root)
    return load_marts(spark, s.prefix, ("genres",))["genres"]


def q_country_mart_read(spark, root):
    s, _, name = _mart_reads(spark, root)
    return load_marts(spark, s.prefix, ("countries",))["countries"]


def q_mart_reads_sorted(spark, root):
    """The report's read of the stored top-titles mart: fixed columns, sorted."""
    mart = Stored.of(spark, root).top_titles
    return mart.sorted().withColumn("genres", marts.tag_string()).select(*marts.TOP_TITLE_COLUMNS)


def q_top_titles_top10_stored(spark, root):
    """The first ten titles of the mart in rank order; the folders below them stay closed."""
    top = Stored.of(spark, root).top_titles.top(10)
    return top.withColumn("genres", marts.tag_string()).select(C.KEY, *marts.TOP_TITLE_COLUMNS)


def q_row_counts_stored(spark, root):
    """Counts from the files' footers."""
    s = Stored.of(spark, root)
    return audit.footer_row_counts(movies=read_for_counts(spark, s.path(s.movies)), movie_genres=read_for_counts(spark, s.path(s.movie_genres)))


def q_link_audit(spark, root):
    s = Stored.of(spark, root)
    return links.link_audit(s.staged(), s.tags())


def q_unlinked_titles(spark, root):
    s = Stored.of(spark, root)
    return links.unlinked(s.staged(), s.tags())


def q_unlinked_tag_rows(spark, root):
    s = Stored.of(spark, root)
    return links.split_linked(s.tags().select(C.KEY, "title", "genre"), s.staged())[1]


def q_title_sketches(spark, root):
    """Distinct titles by country, year, tag and in all, from merged sketches,
    against exact counts."""
    s = Stored.of(spark, root)
    rows = s.tags().select("title", "genre", C.KEY).join(s.titles().select(C.KEY, "country", "release_year"), C.KEY)
    return sketches.accuracy(spark.table(s.title_sketches), rows)


def q_inferred_types(spark, root):
    return inference.inferred_types(inference.class_counts(Catalog(spark, root).raw))


# Two versions of the titles (``stored.older``): what differs, and loads of only that.

def q_change_diff(spark, root):
    titles = Stored.of(spark, root).catalog.titles
    return changes.diff(older(titles), titles, (C.KEY,))


def q_refresh_changed(spark, root):
    """The older version, then a refresh that rewrites what differs."""
    titles, name = Stored.of(spark, root).catalog.titles, _new_name()
    refresh_changed(older(titles), name, (C.KEY,), parts=16, root=scratch_root(spark))
    refresh_changed(titles, name, (C.KEY,), parts=16, root=scratch_root(spark))
    return stored_rows(spark, name)     # its partitions are the catalog's, so the entry stays


def q_genre_mart_incremental(spark, root):
    return Stored.of(spark, root).marts.genre_mart()


def q_country_mart_incremental(spark, root):
    return Stored.of(spark, root).marts.country_mart()


def q_top_titles_mart_incremental(spark, root):
    s = Stored.of(spark, root)
    top = s.marts.top_titles(s.catalog.p.budget_cuts, s.catalog.p.roi_cuts)
    return top.withColumn("genres", marts.tag_string()).select(C.KEY, *marts.TOP_TITLE_COLUMNS)


QUERIES: dict[str, Query] = {
    "raw_catalog": q_raw_catalog,
    "clean_titles": q_clean_titles,
    "normalized_tags": q_normalized_tags,
    "staged_titles": q_staged_titles,
    "genre_mart": q_genre_mart,
    "country_mart": q_country_mart,
    "top_titles_mart": q_top_titles_mart,
    "top_titles_compact": q_top_titles_compact,
    "ordered_tag_string": q_ordered_tag_string,
    "tag_counts_top10": q_tag_counts_top10,
    "roi_top5_nulls_first": q_roi_top5_nulls_first,
    "roi_top5_nulls_last": q_roi_top5_nulls_last,
    "genre_top5": q_genre_top5,
    "country_top5": q_country_top5,
    "row_counts": q_row_counts,
    "null_audit": q_null_audit,
    "transform_summary": q_transform_summary,
    "distinct_tags": q_distinct_tags,
    "duplicate_titles": q_duplicate_titles,
    "reject_reasons": q_reject_reasons,
    "report_genre_revenue": q_report_genre_revenue,
    "report_budget_vs_revenue": q_report_budget_vs_revenue,
    "report_top_titles": q_report_top_titles,
    "report_countries": q_report_countries,
    "report_roi_by_genre": q_report_roi_by_genre,
    "global_rank_titles": q_global_rank_titles,
    "genre_mart_global_rank": q_genre_mart_global_rank,
    "country_mart_global_rank": q_country_mart_global_rank,
    "top_titles_mart_salted": q_top_titles_mart_salted,
    "normalized_tags_dictionary_table": q_normalized_tags_dictionary_table,
    "csv_round_trip": q_csv_round_trip,
    "refresh_movies": q_refresh_movies,
    "refresh_movie_genres": q_refresh_movie_genres,
    "append_movie_genres": q_append_movie_genres,
    "view_stg_movies": q_view_stg_movies,
    "hand_off_titles": q_hand_off_titles,
    "genre_mart_stored": q_genre_mart_stored,
    "top_titles_mart_stored": q_top_titles_mart_stored,
    "staged_tags": q_staged_tags,
    "genre_mart_read": q_genre_mart_read,
    "country_mart_read": q_country_mart_read,
    "mart_reads_sorted": q_mart_reads_sorted,
    "top_titles_top10_stored": q_top_titles_top10_stored,
    "row_counts_stored": q_row_counts_stored,
    "link_audit": q_link_audit,
    "unlinked_titles": q_unlinked_titles,
    "unlinked_tag_rows": q_unlinked_tag_rows,
    "title_sketches": q_title_sketches,
    "inferred_types": q_inferred_types,
    "change_diff": q_change_diff,
    "refresh_changed": q_refresh_changed,
    "genre_mart_incremental": q_genre_mart_incremental,
    "country_mart_incremental": q_country_mart_incremental,
    "top_titles_mart_incremental": q_top_titles_mart_incremental,
}
