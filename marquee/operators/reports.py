"""Chart-ready report tables read from the marts (rendering is not built).

Each is a projection, an optional filter and a sort or top-k over a mart;
scaling to billions/millions rounds like the reference's pandas ``round``
(``round_float``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.numeric import round_float
from marquee.operators.topk import names as _names, top_k


def genre_revenue(genre_mart: DataFrame, k: int = 10) -> DataFrame:
    """Top-k tags by revenue rank; total in billions (2 places)."""
    top = top_k(genre_mart, k, [F.col("revenue_rank").asc(), F.col("genre").asc_nulls_last()])
    return top.select("genre", "revenue_rank",
                      round_float(F.col("total_box_office") / F.lit(1e9), 2).alias("total_box_office_b"),
                      "avg_roi")


def budget_vs_revenue(top_titles: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every title with a known box office: budget, box office, ROI tier and
    absolute ROI (the bubble size)."""
    return (top_titles.filter(F.col("box_office").isNotNull())
            .select(*keep, "title", "director", "release_year", "country", "budget", "box_office",
                    "roi_category", F.abs("roi").alias("roi_abs")))


def top_titles(top_titles_mart: DataFrame, k: int = 10, tie: str | tuple[str, ...] | None = None) -> DataFrame:
    """Top-k titles by box office; amount in billions (2 places)."""
    order = [F.col("box_office").desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in _names(tie)]
    top = top_k(top_titles_mart.filter(F.col("box_office").isNotNull()), k, order)
    keep = [c for c in _names(tie) if c not in ("title", "release_year")]
    return top.select(*keep, "title", "box_office",
                      round_float(F.col("box_office") / F.lit(1e9), 2).alias("box_office_b"),
                      "budget_category")


def countries(country_mart: DataFrame, min_titles: int = 3, k: int = 10) -> DataFrame:
    """Countries with more than ``min_titles`` titles, first k by revenue
    rank: ROI as double, average box office in millions (1 place) and the
    ROI label rounded to 1 place."""
    big = country_mart.filter(F.col("movie_count") > min_titles)
    top = top_k(big, k, [F.col("revenue_rank").asc(), F.col("country").asc_nulls_last()])
    roi = F.col("avg_roi").cast("double")
    return top.select("country", "revenue_rank", "movie_count", roi.alias("avg_roi"),
                      round_float(F.col("avg_box_office") / F.lit(1e6), 1).alias("avg_box_office_m"),
                      round_float(roi, 1).alias("avg_roi_label"))


def roi_by_tag(genre_mart: DataFrame) -> DataFrame:
    """All tags with average ROI as double (readers sort ascending)."""
    return genre_mart.select("genre", F.col("avg_roi").cast("double").alias("avg_roi"))
