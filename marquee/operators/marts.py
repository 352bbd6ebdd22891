"""Aggregate marts: genre, country and top titles.

The reference joins tags to titles on the title text, so a title that
repeats n times with m tag rows fans out to n*m join rows. Here both sides
are first reduced to one row per title (sums and counts of the title side,
multiplicity ``k`` of each (title, tag) on the tag side) and the mart sums
``k * sum``: the same numbers, with a join bounded by the distinct pairs,
so a hot title cannot blow up the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.numeric import exact_avg_cents, exact_avg_int
from marquee.functions.tags import ordered_repeat_join
from marquee.operators.ranking import global_rank, rank_window
from marquee.operators.skew import lookup_join

MART_COLUMNS = ("movie_count", "avg_budget", "avg_box_office", "avg_roi",
                "total_box_office", "revenue_rank")
TOP_TITLE_COLUMNS = ("title", "release_year", "director", "country", "budget", "box_office",
                     "roi", "budget_category", "roi_category", "genres")


def _dec(c: str):
    return F.col(c).cast("decimal(38,0)")


def _cents(c: str):
    return (F.col(c) * 100).cast("decimal(38,0)")


def title_sums(staged: DataFrame) -> DataFrame:
    """One row per title: row count, sums and non-null counts of the money
    columns (ROI as integer cents)."""
    return staged.groupBy("title").agg(
        F.count(F.lit(1)).alias("t_rows"),
        F.sum(_dec("budget")).alias("t_budget"), F.count("budget").alias("t_nbudget"),
        F.sum(_dec("box_office")).alias("t_box"), F.count("box_office").alias("t_nbox"),
        F.sum(_cents("roi")).alias("t_roi"), F.count("roi").alias("t_nroi"))


def tag_multiplicity(tags: DataFrame, tag: str = "genre") -> DataFrame:
    """(title, tag, k): how many tag rows each pair has (partial aggregate
    before the shuffle, so repeats collapse map-side)."""
    return tags.groupBy("title", tag).agg(F.count(F.lit(1)).alias("k"))


def genre_mart_one_pass(wide: DataFrame, rank_impl: str = "global", tag_list: str = "genre_list",
                        tag: str = "genre") -> DataFrame:
    """``genre_mart`` from ``clean_wide`` rows (title, money, tag list) in one
    pass and without a title join.

    Each row gives one money row (``m``; only with a known box office) and one
    row per tag; both are combined by (title, tag) before the shuffle. Then
    every title's money sums stand beside its distinct tags (a window over the
    title: bounded by the distinct tags, however often a title repeats), and
    tags are summed. Sums by (title, tag) are long (ANSI mode raises on
    overflow); they widen to decimal only from there on."""
    money = {"budget": F.col("budget"), "nbudget": F.col("budget").isNotNull().cast("bigint"),
             "box": F.col("box_office"), "nbox": F.lit(1).cast("bigint"),
             "roi": (F.col("roi") * 100).cast("bigint"), "nroi": F.col("roi").isNotNull().cast("bigint")}
    zero = F.lit(0).cast("bigint")
    money_row = F.struct(F.lit(True).alias("m"), F.lit(None).cast("string").alias("tag"),
                         *[F.coalesce(v, zero).alias(c) for c, v in money.items()])

    def tag_row(x):
        return F.struct(F.lit(False).alias("m"), x.alias("tag"), *[zero.alias(c) for c in money])

    rows = F.concat(F.filter(F.array(money_row), lambda _: F.col("box_office").isNotNull()),
                    F.transform(F.coalesce(F.col(tag_list), F.array().cast("array<string>")), tag_row))
    pairs = (wide.filter(F.col("title").isNotNull()).select("title", F.explode(rows).alias("r")).select("title", "r.*")
             .groupBy("title", "m", "tag").agg(F.count(F.lit(1)).alias("k"), *[F.sum(c).alias(c) for c in money]))
    by_title = Window.partitionBy("title")
    beside = pairs.select(
        "m", F.col("tag").alias(tag), F.col("k").cast("decimal(38,0)").alias("k"),
        F.max("m").over(by_title).alias("staged"),
        *[F.sum(F.when(F.col("m"), F.col(c))).over(by_title).cast("decimal(38,0)").alias(c) for c in money])
    agg = beside.filter(~F.col("m") & F.col("staged")).groupBy(tag).agg(
        F.count(F.lit(1)).alias("movie_count"),
        F.sum(F.col("k") * F.col("budget")).alias("s_budget"), F.sum(F.col("k") * F.col("nbudget")).alias("n_budget"),
        F.sum(F.col("k") * F.col("box")).alias("s_box"), F.sum(F.col("k") * F.col("nbox")).alias("n_box"),
        F.sum(F.col("k") * F.col("roi")).alias("s_roi"), F.sum(F.col("k") * F.col("nroi")).alias("n_roi"))
    return _finish(agg, tag, rank_impl)


def _finish(agg: DataFrame, group: str, rank_impl: str) -> DataFrame:
    out = agg.select(
        F.col(group),
        F.col("movie_count"),
        exact_avg_int("s_budget", "n_budget").alias("avg_budget"),
        exact_avg_int("s_box", "n_box").alias("avg_box_office"),
        exact_avg_cents("s_roi", "n_roi").alias("avg_roi"),
        F.col("s_box").cast("bigint").alias("total_box_office"))
    if rank_impl == "global":
        ranked = global_rank(out, "total_box_office", "revenue_rank", stage_input=True).withColumn(
            "revenue_rank", F.col("revenue_rank").cast("int"))
    else:
        ranked = rank_window(out, "total_box_office", "revenue_rank")
    return ranked.select(group, *MART_COLUMNS)


def genre_mart(staged: DataFrame, tags: DataFrame, rank_impl: str = "global") -> DataFrame:
    """Per tag: distinct titles, exact rounded averages of budget, box office
    and ROI, total box office and its rank (gaps on ties).

    Same numbers as ``tags LEFT JOIN titles ON title WHERE box_office IS NOT
    NULL GROUP BY genre``; the join is inner because titles are staged rows
    (box office known). Tags are free text, so the rank is the range-bucketed
    one; ``rank_impl='window'`` ranks few groups in one task."""
    per_title = title_sums(staged)
    pairs = tag_multiplicity(tags).join(per_title, "title", "inner")
    # k * n counts the join rows of the plain n*m join; for a heavily repeated
    # title that exceeds a long, so counts are summed as decimal(38,0) too
    k = F.col("k").cast("decimal(38,0)")
    agg = pairs.groupBy("genre").agg(
        F.count(F.lit(1)).alias("movie_count"),
        F.sum(k * F.col("t_budget")).alias("s_budget"), F.sum(k * F.col("t_nbudget")).alias("n_budget"),
        F.sum(k * F.col("t_box")).alias("s_box"), F.sum(k * F.col("t_nbox")).alias("n_box"),
        F.sum(k * F.col("t_roi")).alias("s_roi"), F.sum(k * F.col("t_nroi")).alias("n_roi"))
    return _finish(agg, "genre", rank_impl)


def country_mart(staged: DataFrame, rank_impl: str = "global") -> DataFrame:
    """Per country (NULL is a group): title count, exact averages, total box
    office, rank. One partial/final aggregate; a hot country is combined
    map-side before the shuffle."""
    agg = (staged.filter(F.col("box_office").isNotNull())
           .groupBy("country").agg(
               F.count("title").alias("movie_count"),
               F.sum(_dec("budget")).alias("s_budget"), F.count("budget").alias("n_budget"),
               F.sum(_dec("box_office")).alias("s_box"), F.count("box_office").alias("n_box"),
               F.sum(_cents("roi")).alias("s_roi"), F.count("roi").alias("n_roi")))
    return _finish(agg, "country", rank_impl)


def title_tag_counts(tags: DataFrame, tag: str = "genre", collation: str | None = None) -> DataFrame:
    """(title, tag_counts): the title's distinct tags in order, each with the
    number of rows that hold it; NULL tags skipped. The compact form of the
    ordered tag string: its size follows the distinct tags, so a title that
    repeats billions of times is still one short row."""
    t = F.col(tag) if collation is None else F.collate(F.col(tag), collation)
    counts = (tags.filter(F.col(tag).isNotNull())
              .groupBy("title", tag).agg(F.count(F.lit(1)).alias("n")))
    return (counts.groupBy("title")
            .agg(F.sort_array(F.collect_list(F.struct(t.alias("tag"), F.col("n")))).alias("tag_counts")))


def tag_string(counts: str = "tag_counts", sep: str = ", "):
    """The ordered string with every tag repeated n times: a read-time form.
    A string has room for 2 GB, so this form (not the stored one) is bounded
    by a title's rows."""
    return ordered_repeat_join(F.col(counts), sep).cast("string")


def ordered_tag_string(tags: DataFrame, tag: str = "genre", sep: str = ", ",
                       collation: str | None = None) -> DataFrame:
    """(title, genres): all tag rows of a title joined in order, duplicates
    kept, NULL tags skipped (``string_agg(genre, ', ' ORDER BY genre)``).
    Order is by bytes unless ``collation`` names a Spark collation (e.g.
    ``'UNICODE'``, the database-style order)."""
    return title_tag_counts(tags, tag, collation).select("title", tag_string(sep=sep).alias("genres"))


def top_titles_compact(staged: DataFrame, tags: DataFrame, keep: tuple[str, ...] = (), salts: int = 1) -> DataFrame:
    """Every staged title with its tag counts (LEFT JOIN, n:1): the stored
    form of the top-titles mart. A hot title is split at run time by AQE
    skew-join, or explicitly with ``salts`` > 1 (``operators.skew``)."""
    g = title_tag_counts(tags)
    return lookup_join(staged, g, "title", "left", salts).select(*keep, *TOP_TITLE_COLUMNS[:-1], "tag_counts")


def top_titles_mart(staged: DataFrame, tags: DataFrame, keep: tuple[str, ...] = (), salts: int = 1) -> DataFrame:
    """``top_titles_compact`` as it is read: with the ordered tag string.
    Unsorted; readers sort (see ``reports``)."""
    return (top_titles_compact(staged, tags, keep, salts)
            .withColumn("genres", tag_string()).select(*keep, *TOP_TITLE_COLUMNS))
