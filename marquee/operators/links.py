"""The foreign key that the loader claims but nothing enforces: tags belong to
titles by the title text.

``link_audit`` counts, in both directions, what has no partner. Each side is
reduced to (title, rows) where it is read, both are added up in one aggregate
by title, and what has rows on one side only is unlinked: one shuffle of
distinct titles, so an orphan title with a third of the rows is a few rows per
task. ``split_linked`` then separates the rows themselves by an anti and a semi
join against the orphans' titles, a list that Spark broadcasts only when it
has measured it as small; beyond that it is a plain shuffle join, which
adaptive execution splits at a hot title.

A null title has no partner on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAGS_ALONE, TITLES_ALONE = "tags_without_title", "titles_without_tag"


def unlinked(titles: DataFrame, tags: DataFrame, key: str = "title") -> DataFrame:
    """(side, title, rows) of every title that only one of the tables has."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = (titles.select(F.col(key).alias("title"), one.alias("t"), zero.alias("g"))
            .unionByName(tags.select(F.col(key).alias("title"), zero.alias("t"), one.alias("g"))))
    by_title = both.groupBy("title").agg(F.sum("t").alias("t"), F.sum("g").alias("g"))
    alone = F.col("title").isNull()
    sides = F.filter(F.array(F.struct(F.lit(TAGS_ALONE).alias("side"), F.when(alone | (F.col("t") == 0), F.col("g")).alias("rows")),
                             F.struct(F.lit(TITLES_ALONE).alias("side"), F.when(alone | (F.col("g") == 0), F.col("t")).alias("rows"))),
                     lambda s: s["rows"] > 0)
    return by_title.select("title", F.explode(sides).alias("s")).select("s.side", "title", "s.rows")


def link_audit(titles: DataFrame, tags: DataFrame, key: str = "title") -> DataFrame:
    """(side, titles, rows): distinct unlinked titles and their rows, one row a
    side (a side without any is a row of zeros)."""
    found = unlinked(titles, tags, key).groupBy("side").agg(F.count("title").alias("titles"), F.sum("rows").alias("rows"))
    sides = titles.sparkSession.createDataFrame([(TAGS_ALONE,), (TITLES_ALONE,)], "side string")
    return sides.join(found, "side", "left").select("side", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("titles", "rows")])


def split_linked(tags: DataFrame, titles: DataFrame, key: str = "title") -> tuple[DataFrame, DataFrame]:
    """(tag rows with a title, tag rows without one and ``reason``)."""
    orphans = unlinked(titles, tags, key).where(F.col("side") == TAGS_ALONE).where(F.col("title").isNotNull()).select(F.col("title").alias(key))
    named, nameless = tags.where(F.col(key).isNotNull()), tags.where(F.col(key).isNull())
    reason = F.lit("title_not_found").alias("reason")
    return (named.join(orphans, key, "left_anti").select(*tags.columns),
            named.join(orphans, key, "left_semi").unionByName(nameless).select(*tags.columns, reason))
