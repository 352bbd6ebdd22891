"""Marts that take batches: stored partial sums that a batch is added to.

The genre mart multiplies, for each (title, tag) pair, the pair's tag rows k
with the title's money sums. Both factors are sums over rows, so they are kept
as such: one row per title and batch, one per pair and batch, one per country
and batch. Rows carry a weight (+1 loaded, -1 withdrawn, n for repeats), so a
correction is the withdrawal of the old row and the load of the new one
(``operators.changes.signed_rows`` gives both).

A batch changes the product only for the titles it touches: their state
before (summed over earlier batches) and after gives a difference per tag,
which is stored as the batch's own part of the mart. Reading the mart sums one
row per tag and batch; no read and no load scans the raw rows of earlier
batches. The top-titles mart is made at read from two sums, of equal title rows
and of (title, tag) pairs.

A batch is written below its own folder, so a batch that failed half-way or
runs twice overwrites what it had left. The last batch may be repeated with
other rows; an earlier one only with the same. ``compact`` folds all batches
into one. A title that holds a third of the rows is one row per batch in the
state, and its tags one row per pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import quoted
from marquee.functions.tiers import BUDGET_CUTS, ROI_CUTS
from marquee.operators import marts, staging
from marquee.operators.changes import WEIGHT
from marquee.operators.clean import TITLE_COLUMNS
from marquee.sinks.tables import _exists, _fs_path, _read_text, _write_text, remove_path

MONEY = ("budget", "box_office", "roi")
SUMS = tuple(f"{p}_{c}" for c in MONEY for p in ("s", "n"))
WIDE = "decimal(38,0)"
#: Folder of folded parts on their way, its mark of completeness, and the number of the last folded batch.
COMPACT, READY, FOLDED = "_compact", "_READY", "_FOLDED"


def _weight(df: DataFrame):
    return F.col(WEIGHT).cast("long") if WEIGHT in df.columns else F.lit(1).cast("long")


def _signed_sums(df: DataFrame) -> list:
    """Sums and non-null counts of the money columns, each row times its weight
    (ROI as whole cents)."""
    w, out = _weight(df), []
    for c in MONEY:
        v = (F.col(c) * 100).cast(WIDE) if c == "roi" else F.col(c).cast(WIDE)
        out += [F.coalesce(F.sum((v * w.cast(WIDE)).cast(WIDE)), F.lit(0)).cast(WIDE).alias(f"s_{c}"),
                F.coalesce(F.sum(F.when(F.col(c).isNotNull(), w)), F.lit(0)).cast("long").alias(f"n_{c}")]
    return out


def title_part(titles: DataFrame) -> DataFrame:
    """(title, t_rows, sums) of titles with a known box office."""
    known = titles.where(F.col("box_office").isNotNull() & F.col("title").isNotNull())
    return known.groupBy("title").agg(F.sum(_weight(titles)).alias("t_rows"), *_signed_sums(titles))


def tag_part(tags: DataFrame) -> DataFrame:
    """(title, genre, k): a null genre is a genre, a null title joins nothing."""
    return tags.where(F.col("title").isNotNull()).groupBy("title", "genre").agg(F.sum(_weight(tags)).alias("k"))


def country_part(titles: DataFrame) -> DataFrame:
    known = titles.where(F.col("box_office").isNotNull())
    return known.groupBy("country").agg(F.sum(_weight(titles)).alias("t_rows"),
                                        F.coalesce(F.sum(F.when(F.col("title").isNotNull(), _weight(titles))), F.lit(0)).alias("movie_count"),
                                        *_signed_sums(titles))


def row_part(titles: DataFrame) -> DataFrame:
    """The title rows with a known box office, equal ones as one with ``copies``."""
    columns = [c for c in titles.columns if c != WEIGHT]
    known = titles.where(F.col("box_office").isNotNull())
    return known.groupBy(*map(quoted, columns)).agg(F.sum(_weight(titles)).alias("copies"))


def _total(df: DataFrame, *by: str) -> DataFrame:
    """Parts of several batches added up."""
    values = [c for c in df.columns if c not in by]
    types = dict(df.dtypes)
    return df.groupBy(*map(quoted, by)).agg(*[F.sum(c).cast(types[c]).alias(c) for c in values])


class MartState:
    """Partial sums of the marts in a folder, one sub-folder per part and batch."""

    PARTS = ("rows", "titles", "tags", "countries", "genres")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._take_compacted()

    def _folder(self, part: str, batch: int) -> str:
        return f"{self.path}/{part}/{batch:08d}"

    def batches(self, part: str = "genres") -> list[int]:
        """Batches that are complete in ``part``, in order."""
        fs, p = _fs_path(self.spark, f"{self.path}/{part}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(int(n) for n in names if n.isdigit() and _exists(self.spark, f"{self.path}/{part}/{n}/_SUCCESS"))

    def _read(self, part: str, batches: list[int]) -> DataFrame | None:
        return self.spark.read.parquet(*[self._folder(part, b) for b in batches]) if batches else None

    def _write(self, df: DataFrame, part: str, batch: int) -> DataFrame:
        path = self._folder(part, batch)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, batch: int, titles: DataFrame, tags: DataFrame) -> None:
        """Load a batch: titles (title, country, money and what else the
        top-titles mart shows) and tags (title, genre), each with an optional
        ``weight``."""
        folded = self._folded()
        if folded is not None and batch <= folded:
            raise ValueError(f"batch {batch} is folded into others up to {folded}")
        earlier = [b for b in self.batches() if b < batch]
        if any(b > batch for b in self.batches()) and batch not in self.batches():
            raise ValueError(f"batch {batch} is older than the last one loaded")
        remove_path(self.spark, self._folder("genres", batch))       # incomplete until its last part is written
        # the batch is read once: the other title parts are sums of its distinct rows
        rows = self._write(row_part(titles), "rows", batch).withColumnRenamed("copies", WEIGHT)
        self._write(country_part(rows), "countries", batch)
        t = self._write(title_part(rows), "titles", batch)
        g = self._write(tag_part(tags), "tags", batch)
        old_t, old_g = self._read("titles", earlier), self._read("tags", earlier)
        if old_t is None:
            old_t, old_g = t.limit(0), g.limit(0)
        else:
            # only the touched titles' state is read on; it is small when the batch is
            touched = t.select("title").union(g.select("title")).distinct()
            old_t, old_g = old_t.join(touched, "title", "left_semi"), old_g.join(touched, "title", "left_semi")
        self._write(self._delta(old_t, t, old_g, g), "genres", batch)

    @staticmethod
    def _beside(old: DataFrame, new: DataFrame, *by: str) -> DataFrame:
        """Sums without the batch (``old_`` before their names) and with it, from one shuffle by title."""
        types = dict(new.dtypes)
        values = [c for c in new.columns if c not in by]
        both = new.withColumn("_late", F.lit(True)).unionByName(old.withColumn("_late", F.lit(False)))
        return (both.repartition("title").groupBy(*map(quoted, by))
                .agg(*[F.sum(c).cast(types[c]).alias(c) for c in values],
                     *[F.coalesce(F.sum(F.when(~F.col("_late"), F.col(c))), F.lit(0)).cast(types[c]).alias(f"old_{c}") for c in values]))

    @staticmethod
    def _delta(old_t: DataFrame, t: DataFrame, old_g: DataFrame, g: DataFrame) -> DataFrame:
        """(genre, movie_count, sums): what the batch adds to the product over
        pairs with tag rows and staged titles."""
        pairs = MartState._beside(old_g, g, "title", "genre").join(MartState._beside(old_t, t, "title"), "title")
        pairs = (pairs.withColumn("_now", (F.col("k") > 0) & (F.col("t_rows") > 0))
                 .withColumn("_then", (F.col("old_k") > 0) & (F.col("old_t_rows") > 0)).where("_now OR _then"))
        zero = F.lit(0).cast(WIDE)

        def product(there: str, k: str, c: str):
            return F.when(F.col(there), (F.col(k).cast(WIDE) * F.col(c).cast(WIDE)).cast(WIDE)).otherwise(zero)

        return (pairs.groupBy("genre")
                .agg(F.sum(F.col("_now").cast("long") - F.col("_then").cast("long")).alias("movie_count"),
                     *[F.sum((product("_now", "k", c) - product("_then", "old_k", f"old_{c}")).cast(WIDE)).cast(WIDE).alias(c) for c in SUMS]))

    def genre_mart(self, rank_impl: str = "global") -> DataFrame:
        return self._mart("genres", "genre", "movie_count", rank_impl)

    def country_mart(self, rank_impl: str = "global") -> DataFrame:
        return self._mart("countries", "country", "t_rows", rank_impl)

    def top_titles(self, budget_cuts: Sequence[float] = BUDGET_CUTS, roi_cuts: Sequence[float] = ROI_CUTS) -> DataFrame:
        """The compact top-titles mart: every staged row with its tag counts."""
        batches = self._complete()
        rows = self._read("rows", batches)
        columns = [c for c in rows.columns if c != "copies"]
        net = _total(rows, *columns).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
        staged = staging.staged_titles(net.select("*", *[F.lit(None).alias(c) for c in TITLE_COLUMNS if c not in columns]), budget_cuts, roi_cuts)
        pairs = _total(self._read("tags", batches), "title", "genre").where("k > 0 AND genre IS NOT NULL")
        counts = pairs.groupBy("title").agg(F.sort_array(F.collect_list(F.struct(F.col("genre").alias("tag"), F.col("k").alias("n")))).alias("tag_counts"))
        keep = [c for c in columns if c not in TITLE_COLUMNS]
        return staged.join(counts, "title", "left").select(*map(quoted, keep), *marts.TOP_TITLE_COLUMNS[:-1], "tag_counts")

    def _complete(self) -> list[int]:
        batches = self.batches()        # a batch counts when its last part is written
        if not batches:
            raise FileNotFoundError(f"{self.path}: no batch loaded")
        return batches

    def _mart(self, part: str, by: str, alive: str, rank_impl: str) -> DataFrame:
        total = _total(self._read(part, self._complete()), by).where(f"{alive} > 0")
        named = {"s_budget": "s_budget", "n_budget": "n_budget", "s_box_office": "s_box", "n_box_office": "n_box", "s_roi": "s_roi", "n_roi": "n_roi"}
        return marts._finish(total.select(by, "movie_count", *[F.col(a).alias(b) for a, b in named.items()]), by, rank_impl)

    def compact(self) -> int:
        """Fold all complete batches into one, under the last one's number. All
        folded parts are written beside the state first, then take the batches'
        place; a folded batch can't be loaded again."""
        batches = self.batches()
        if len(batches) < 2:
            return len(batches)
        columns = [c for c in self._read("rows", batches).columns if c != "copies"]
        keys = {"rows": tuple(columns), "titles": ("title",), "tags": ("title", "genre"), "countries": ("country",), "genres": ("genre",)}
        other = f"{self.path}/{COMPACT}"
        remove_path(self.spark, other)
        for part in self.PARTS:
            alive = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in self._read(part, batches[:1]).columns if c not in keys[part]])
            _total(self._read(part, batches), *keys[part]).where(alive).write.parquet(f"{other}/{part}/{batches[-1]:08d}")
        _write_text(self.spark, f"{other}/{READY}", str(batches[-1]))
        self._take_compacted()
        return 1

    def _take_compacted(self) -> None:
        """Put complete folded parts in the batches' place; what an earlier
        attempt left over is taken up where it stopped."""
        other = f"{self.path}/{COMPACT}"
        if not _exists(self.spark, f"{other}/{READY}"):
            return
        last = _read_text(self.spark, f"{other}/{READY}")
        for part in self.PARTS:
            if _exists(self.spark, f"{other}/{part}"):
                remove_path(self.spark, f"{self.path}/{part}")
                fs, p = _fs_path(self.spark, f"{self.path}/{part}")
                fs.rename(_fs_path(self.spark, f"{other}/{part}")[1], p)
        remove_path(self.spark, f"{self.path}/{FOLDED}")
        _write_text(self.spark, f"{self.path}/{FOLDED}", last)
        remove_path(self.spark, other)

    def _folded(self) -> int | None:
        """The last batch that can no longer be loaded again."""
        path = f"{self.path}/{FOLDED}"
        return int(_read_text(self.spark, path)) if _exists(self.spark, path) else None
