"""End-to-end batch: extract -> clean -> validate -> load -> model -> audit.

One driver program and one lazy lineage per stage; the stage boundaries are
written tables, so a failed run can be retried from the last good table and a
lost executor only recomputes from the nearest written copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schema
from marquee.functions.tags import GENRE_CORRECTIONS
from marquee.functions.tiers import BUDGET_CUTS, BUDGET_LABELS, ROI_CUTS, ROI_LABELS
from marquee.operators import audit, clean, links, marts, staging
from marquee.operators.clean import TITLE_COLUMNS
from marquee.plans.incremental import MartState
from marquee.sinks.buckets import read_bucketed
from marquee.sinks.tables import Buckets, attach, default_root, full_refresh, hand_off, remove_path
from marquee.sinks.views import VIEWS, open_warehouse, save_view


TABLES = ("movies", "movie_genres", "movies_rejects", "movie_genres_rejects",
          "mart_genre_analysis", "mart_country_analysis", "mart_top_movies")


def run_pipeline(spark: SparkSession, raw: DataFrame, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
                 budget_cuts: Sequence[float] = BUDGET_CUTS, roi_cuts: Sequence[float] = ROI_CUTS,
                 root: str | None = None, prefix: str = "", keep: Sequence[str] = (),
                 rank_impl: str = "global", buckets: int | None = None, check_links: bool = False) -> dict:
    """Run the whole batch on ``raw`` (all-string columns) and return counts.

    * the cleaned wide rows (title columns, tag list, first broken rule) are
      written once to the shared checkpoint folder; all four tables are split
      from that copy, so the source is read and cleaned once.
    * rows breaking a load rule go to ``{prefix}movies_rejects`` /
      ``{prefix}movie_genres_rejects`` with a reason instead of failing the
      load; the counts are returned.
    * each table is replaced with ``full_refresh`` (never empty to readers)
      and only if it holds as many rows as the wide copy says.
    * the staging views are kept beside the tables with this run's cut points,
      for later sessions (``sinks.views``).
    * ``rank_impl='window'`` ranks the marts in one task instead, for catalogues
      whose genre and country counts are known to be small.
    * ``buckets``: store titles and tags by hash of the title, so that the
      marts' joins need no shuffle.
    * ``check_links``: tag rows whose title was not loaded are rejected, too
      (``title_not_found``), as a foreign key would.
    """
    src, src_path, good_t, bad_t, good_g, bad_g = _split(raw, mapping, keep, check_links)

    n = src.agg(F.count_if(F.col("_reason").isNull()).alias("good"), F.count_if(F.col("_reason").isNotNull()).alias("bad"),
                F.coalesce(F.sum(F.size("genre_list")), F.lit(0)).alias("tags")).first()
    out = {}
    by_title = Buckets(buckets, ("title",), ("title",)) if buckets else None
    out["movies"] = full_refresh(good_t, f"{prefix}movies", root, expect_rows=n["good"], schema=schema.MOVIES, buckets=by_title)
    out["movies_rejects"] = full_refresh(bad_t, f"{prefix}movies_rejects", root, expect_rows=n["bad"])
    out["movie_genres_rejects"] = full_refresh(bad_g, f"{prefix}movie_genres_rejects", root)
    out["movie_genres"] = full_refresh(good_g, f"{prefix}movie_genres", root, schema=schema.MOVIE_GENRES,
                                       expect_rows=n["tags"] - out["movie_genres_rejects"]["rows"], buckets=by_title)

    create_staging_views(spark, prefix, budget_cuts, roi_cuts, root, keep)
    # the views' rows, but by bucket where no bucket is too large for a task
    stg_movies = staging.staged_titles(read_bucketed(spark, f"{prefix}movies"), budget_cuts, roi_cuts, BUDGET_LABELS, ROI_LABELS)
    stg_genres = staging.staged_tags(read_bucketed(spark, f"{prefix}movie_genres"))
    out["mart_genre_analysis"] = full_refresh(
        marts.genre_mart(stg_movies, stg_genres, rank_impl), f"{prefix}mart_genre_analysis", root)
    out["mart_country_analysis"] = full_refresh(
        marts.country_mart(stg_movies, rank_impl), f"{prefix}mart_country_analysis", root)
    out["mart_top_movies"] = full_refresh(
        marts.top_titles_compact(stg_movies, stg_genres, keep=tuple(keep)), f"{prefix}mart_top_movies", root)
    remove_path(spark, src_path)    # every table is written; the wide copy is done
    return {k: v["rows"] for k, v in out.items()}


def _split(raw: DataFrame, mapping: Mapping[str, str], keep: Sequence[str], check_links: bool):
    """The wide copy of cleaned rows, its folder, and what passes the load rules and what doesn't."""
    t_rules = {**audit.title_rules(), "roi_out_of_range": audit.roi_out_of_range()}
    wide = clean.clean_wide(raw, mapping, keep=keep, audit=True).withColumn("_reason", audit.first_reason(t_rules))
    src, path = hand_off(wide, "wide", return_path=True)
    titles, tags = clean.split_wide(src, keep=keep)
    good_t = titles.filter(F.col("_reason").isNull()).select(*keep, *TITLE_COLUMNS)
    bad_t = titles.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    good_g, bad_g = audit.split_valid(tags, audit.tag_rules())
    if check_links:
        good_g, alone = links.split_linked(good_g, good_t)
        bad_g = bad_g.unionByName(alone)
    return src, path, good_t, bad_t, good_g, bad_g


def run_batch(spark: SparkSession, raw: DataFrame, batch: int, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
              budget_cuts: Sequence[float] = BUDGET_CUTS, roi_cuts: Sequence[float] = ROI_CUTS, root: str | None = None,
              prefix: str = "", keep: Sequence[str] = (), rank_impl: str = "global") -> dict:
    """Load one batch of raw rows into the stored partial sums and refresh the
    marts from them: the work follows the batch and the sums, not the rows
    loaded before. Rejects go to a folder per batch. A batch that failed or is
    loaded again overwrites what it had left."""
    root = (root or default_root(spark)).rstrip("/")
    state = MartState(spark, f"{root}/{prefix}mart_state")
    _, path, good_t, bad_t, good_g, bad_g = _split(raw, mapping, keep, False)
    out = {}
    for name, df in (("movies_rejects", bad_t), ("movie_genres_rejects", bad_g)):
        df.write.mode("overwrite").parquet(f"{state.path}/{name}/{batch:08d}")
        out[name] = spark.read.schema(df.schema).parquet(f"{state.path}/{name}/{batch:08d}").count()
    state.add(batch, good_t, good_g)
    for name, df in (("mart_genre_analysis", state.genre_mart(rank_impl)), ("mart_country_analysis", state.country_mart(rank_impl)),
                     ("mart_top_movies", state.top_titles(budget_cuts, roi_cuts))):
        out[name] = full_refresh(df, f"{prefix}{name}", root)["rows"]
    remove_path(spark, path)
    return out


def create_staging_views(spark: SparkSession, prefix: str = "", budget_cuts: Sequence[float] = BUDGET_CUTS,
                         roi_cuts: Sequence[float] = ROI_CUTS, root: str | None = None, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The staging models as lasting views over the loaded tables."""
    movies = staging.staged_titles_sql(f"{prefix}movies", budget_cuts, roi_cuts, BUDGET_LABELS, ROI_LABELS, keep)
    return (save_view(spark, f"{prefix}stg_movies", movies, root),
            save_view(spark, f"{prefix}stg_genres", staging.staged_tags_sql(f"{prefix}movie_genres"), root))


def attach_run(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """A finished run's tables and its staging views, in a process of its own."""
    names = [f"{prefix}{t}" for t in TABLES]
    missing = set(names) - set(attach(spark, names, root))
    if missing:
        raise RuntimeError(f"no finished run under {root or default_root(spark)}: {sorted(missing)} not found")
    views = open_warehouse(spark, root)["views"]
    if f"{prefix}stg_movies" not in views:
        raise RuntimeError(f"no staging views under {root or default_root(spark)}/{VIEWS}")


def load_marts(spark: SparkSession, prefix: str = "", which: Sequence[str] = ("genres", "countries", "movies")) -> dict[str, DataFrame]:
    """The mart reads the reports start from: fixed projections, sorted at
    read (a stored table has no order)."""
    cols = ["movie_count", "avg_budget", "avg_box_office", "avg_roi", "total_box_office", "revenue_rank"]
    reads = {
        "genres": lambda: spark.table(f"{prefix}mart_genre_analysis").select("genre", *cols).orderBy("revenue_rank", "genre"),
        "countries": lambda: spark.table(f"{prefix}mart_country_analysis").select("country", *cols).orderBy("revenue_rank", "country"),
        "movies": lambda: (spark.table(f"{prefix}mart_top_movies").withColumn("genres", marts.tag_string())
                           .select("title", "release_year", "director", "country", "budget", "box_office",
                                   "roi", "budget_category", "roi_category", "genres")
                           .filter(F.col("box_office").isNotNull())
                           .orderBy(F.col("box_office").desc(), "title", "release_year")),
    }
    return {name: reads[name]() for name in which}
