"""The catalogue as stored tables, for the queries that read them.

The loader and the modelling step meet in stored tables: titles and tags
bucketed by title (their joins need no shuffle), marts as tables, the
top-titles mart in rank order. ``Stored.of`` keeps one set per session and
table folder in the application's scratch folder and writes a table when a
query first asks for it, so a query's own work is its read.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marquee import schema
from marquee.operators import changes, marts, sketches, staging
from marquee.plans.catalog import KEY, Catalog
from marquee.plans.incremental import MartState
from marquee.session import scratch_root
from marquee.sinks.buckets import location, read_bucketed
from marquee.sinks.clustered import Clustered, refresh_clustered
from marquee.sinks.tables import Buckets, full_refresh, hand_off

TOP_ORDER = (("box_office", "desc"), ("title", "asc"), ("release_year", "asc"), (KEY, "asc"))


def older(titles: DataFrame) -> DataFrame:
    """An earlier version of the titles: some rows aren't there yet, some are
    gone since, some had another budget, some were loaded twice."""
    key = F.col(KEY)
    older = titles.where(key % 7 != 0).withColumn("budget", F.when(key % 5 == 0, F.coalesce(F.col("budget"), F.lit(0)) + 1).otherwise(F.col("budget")))
    gone = titles.where(key % 11 == 0).withColumn(KEY, -key)
    return older.unionByName(gone).unionByName(older.where(key % 13 == 0))


class Stored:
    """Stored tables of one catalogue; each is written once, when it is asked for."""

    _made: dict[tuple[str, str], Stored] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.prefix = f"s{uuid.uuid4().hex[:12]}_"
        self.folder = f"{scratch_root(spark)}/stored"
        self.width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> Stored:
        key = (spark.sparkContext.applicationId, root)
        if key not in cls._made:
            cls._made[key] = cls(spark, root)
        return cls._made[key]

    @cached_property
    def wide(self) -> DataFrame:
        """The cleaned wide rows, written once; all tables are split from them."""
        return hand_off(Catalog(self.spark, self.root).wide, "stored_wide")

    @cached_property
    def catalog(self) -> Catalog:
        c = Catalog(self.spark, self.root, materialize=True)
        c.__dict__["wide"] = self.wide
        return c

    def _refresh(self, df: DataFrame, name: str, fixed: StructType | None = None, buckets: Buckets | None = None) -> str:
        full_refresh(df, f"{self.prefix}{name}", self.folder, schema=fixed, buckets=buckets)
        return f"{self.prefix}{name}"

    @cached_property
    def movies(self) -> str:
        titles = self.catalog.titles
        fixed = StructType([titles.schema[KEY], *[StructField(f.name, f.dataType) for f in schema.MOVIES.fields]])   # rejects stay in
        return self._refresh(titles, "movies", fixed, Buckets(self.width, ("title",), ("title",)))

    @cached_property
    def movie_genres(self) -> str:
        return self._refresh(self.catalog.tags, "movie_genres", buckets=Buckets(self.width, ("title",), ("title",)))

    def titles(self) -> DataFrame:
        return read_bucketed(self.spark, self.movies)

    def tags(self) -> DataFrame:
        return read_bucketed(self.spark, self.movie_genres)

    def staged(self) -> DataFrame:
        p = self.catalog.p
        return staging.staged_titles(self.titles(), p.budget_cuts, p.roi_cuts, p.budget_labels, p.roi_labels)

    @cached_property
    def genre_mart(self) -> str:
        return self._refresh(marts.genre_mart(self.staged(), staging.staged_tags(self.tags()), "global"), "mart_genre_analysis")

    @cached_property
    def country_mart(self) -> str:
        return self._refresh(marts.country_mart(self.staged(), "global"), "mart_country_analysis")

    @cached_property
    def top_titles(self) -> Clustered:
        mart = marts.top_titles_compact(self.staged(), self.tags(), keep=(KEY,))
        path = refresh_clustered(self.spark, mart, f"{self.prefix}mart_top_movies", TOP_ORDER, self.width, self.folder)
        return Clustered(self.spark, path, TOP_ORDER)

    @cached_property
    def title_sketches(self) -> str:
        # plain splits: the groups are other columns than the buckets' key
        rows = self.tags().select("title", "genre", KEY).join(self.titles().select(KEY, "country", "release_year"), KEY)
        return self._refresh(sketches.title_sketches(rows), "title_sketches")

    @cached_property
    def marts(self) -> MartState:
        """Partial sums of the marts, loaded in three batches: an older version
        of the titles with most of the tags, what has changed in the titles since
        (signed rows), and the other tags."""
        c = self.catalog
        state = MartState(self.spark, f"{self.folder}/{self.prefix}state")
        late = F.coalesce(F.pmod(F.xxhash64("genre", KEY), F.lit(3)) == 0, F.lit(False))
        old = older(c.titles)
        state.add(1, old, c.tags.where(~late))
        state.add(2, changes.signed_rows(old, c.titles, (KEY,)), c.tags.limit(0))
        state.add(3, c.titles.limit(0), c.tags.where(late))
        return state

    def path(self, name: str) -> str:
        return location(self.spark, name)
