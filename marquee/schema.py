"""Fixed table schemas (the store's hand-written types)."""

from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

MOVIES = StructType([
    StructField("title", StringType(), False),
    StructField("release_year", IntegerType()),
    StructField("director", StringType()),
    StructField("language", StringType()),
    StructField("country", StringType()),
    StructField("duration", IntegerType()),
    StructField("budget", LongType()),
    StructField("box_office", LongType()),
    StructField("roi", DecimalType(10, 2)),
])

MOVIE_GENRES = StructType([
    StructField("title", StringType(), False),
    StructField("genre", StringType(), False),
])

MART = ("movie_count bigint, avg_budget bigint, avg_box_office bigint, avg_roi decimal(12,2), "
        "total_box_office bigint, revenue_rank int")
GENRE_MART = "genre string, " + MART
COUNTRY_MART = "country string, " + MART
TOP_TITLES_MART = ("title string, release_year int, director string, country string, budget bigint, "
                   "box_office bigint, roi decimal(10,2), budget_category string, "
                   "roi_category string, tag_counts array<struct<tag:string,n:bigint>>")
