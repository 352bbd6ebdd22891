"""Verification reads: top-N checks against the loaded tables and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.audit import row_counts
from marquee.operators.topk import group_count_top, names as _names, top_k


def roi_top(titles: DataFrame, k: int = 5, nulls: str = "first", tie: str | tuple[str, ...] | None = None) -> DataFrame:
    """Top-k titles by ROI, descending. The reference's database sorts NULL
    first on DESC, so with any NULL ROI the first rows are NULL ROIs;
    ``nulls='last'`` gives the ranking most readers expect."""
    roi = F.col("roi").desc_nulls_first() if nulls == "first" else F.col("roi").desc_nulls_last()
    order = [roi] + [F.col(c).asc_nulls_last() for c in _names(tie)]
    keep = [c for c in _names(tie) if c not in ("title", "release_year")]
    return top_k(titles, k, order).select(*keep, "title", "release_year", "budget", "box_office", "roi")


def tag_counts_top(tags: DataFrame, k: int = 10) -> DataFrame:
    return group_count_top(tags, "genre", k, "film_count")


def mart_top(mart: DataFrame, group: str, k: int = 5) -> DataFrame:
    return (top_k(mart, k, [F.col("revenue_rank").asc(), F.col(group).asc_nulls_last()])
            .select(group, "movie_count", "avg_roi", "total_box_office", "revenue_rank"))


def verify(titles: DataFrame, tags: DataFrame, genre_mart: DataFrame,
           country_mart: DataFrame, tie: str | tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """All verification reads as lazy frames."""
    return {
        "roi_top5": roi_top(titles, tie=tie),
        "tag_counts_top10": tag_counts_top(tags),
        "row_counts": row_counts(movies=titles, movie_genres=tags),
        "genre_top5": mart_top(genre_mart, "genre"),
        "country_top5": mart_top(country_mart, "country"),
    }
