"""The catalogue job chain over the driver's tables.

raw_catalog -> (titles, tags) -> staged -> marts, with the dictionary and
tier cut points sized to the derived catalogue. ``Catalog`` builds each lazy
frame once per query so titles and tags share one raw plan; Catalyst prunes
each branch to its columns and pushes the ``box_office IS NOT NULL`` filter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marquee.functions.tags import GENRE_CORRECTIONS
from marquee.functions.tiers import BUDGET_LABELS, ROI_LABELS
from marquee.operators import clean, marts, staging
from marquee.sources.catalog import (CATALOG_BUDGET_CUTS, CATALOG_CORRECTIONS, CATALOG_ROI_CUTS,
                                     raw_catalog)
from marquee.session import ensure_checkpoint_dir

KEY = "o_orderkey"
LIST = "genre_list"


@dataclass(frozen=True)
class CatalogParams:
    corrections: dict = field(default_factory=lambda: {**GENRE_CORRECTIONS, **CATALOG_CORRECTIONS})
    budget_cuts: tuple = CATALOG_BUDGET_CUTS
    roi_cuts: tuple = CATALOG_ROI_CUTS
    budget_labels: tuple = BUDGET_LABELS
    roi_labels: tuple = ROI_LABELS


DEFAULT = CatalogParams()


class Catalog:
    """Lazy frames of one catalogue run.

    With ``materialize=True`` the cleaned wide frame (title columns plus the
    cleaned tag list) is checkpointed when it is first asked for, and both
    titles and tags read that copy: queries that join the two branches run the
    raw joins once instead of twice. Spark deletes the checkpoint once no
    frame refers to it (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """

    def __init__(self, spark: SparkSession, root: str, params: CatalogParams = DEFAULT,
                 raw: DataFrame | None = None, materialize: bool = False):
        self.spark, self.root, self.p, self.materialize = spark, root, params, materialize
        if raw is not None:
            self.__dict__["raw"] = raw

    @cached_property
    def raw(self) -> DataFrame:
        return raw_catalog(self.spark, self.root)

    @cached_property
    def wide(self) -> DataFrame:
        w = clean.clean_wide(self.raw, self.p.corrections, keep=(KEY,), audit=True)
        if not self.materialize:
            return w
        ensure_checkpoint_dir(self.spark)
        return w.checkpoint()

    @cached_property
    def titles(self) -> DataFrame:
        if self.materialize:
            return self.wide.drop(LIST, "roi_unbounded")
        return clean.clean_titles(self.raw, keep=(KEY,))

    @cached_property
    def titles_audit(self) -> DataFrame:
        if self.materialize:
            return self.wide.drop(LIST)
        return clean.clean_titles(self.raw, keep=(KEY,), audit=True)

    @cached_property
    def tags(self) -> DataFrame:
        if self.materialize:
            return clean.split_wide(self.wide, LIST, keep=(KEY,))[1]
        return clean.normalize_tags(self.raw, self.p.corrections, keep=(KEY,))

    @cached_property
    def staged(self) -> DataFrame:
        p = self.p
        return staging.staged_titles(self.titles, p.budget_cuts, p.roi_cuts,
                                     p.budget_labels, p.roi_labels)

    def genre_mart(self, rank_impl: str = "global") -> DataFrame:
        return marts.genre_mart_one_pass(self.wide, rank_impl)

    def country_mart(self, rank_impl: str = "global") -> DataFrame:
        return marts.country_mart(self.staged, rank_impl)

    @cached_property
    def top_titles_mart(self) -> DataFrame:
        return marts.top_titles_mart(self.staged, self.tags, keep=(KEY,))

    @cached_property
    def ordered_tag_string(self) -> DataFrame:
        return marts.ordered_tag_string(self.tags)
