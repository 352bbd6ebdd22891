"""Staging views: analytic rows with tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.tiers import BUDGET_CUTS, BUDGET_LABELS, ROI_CUTS, ROI_LABELS, bucket_label
from marquee.functions.text import quoted
from marquee.operators.clean import TITLE_COLUMNS


def staged_titles(titles: DataFrame, budget_cuts: Sequence[float] = BUDGET_CUTS,
                  roi_cuts: Sequence[float] = ROI_CUTS,
                  budget_labels: Sequence[str] = BUDGET_LABELS,
                  roi_labels: Sequence[str] = ROI_LABELS) -> DataFrame:
    """Titles with a known box office, plus budget and ROI tiers.

    The filter is a plain ``isnotnull`` that Catalyst pushes into the scan of
    a stored titles table. A NULL budget or ROI falls into the last tier (the
    CASE's ELSE), as in the reference."""
    extra = [c for c in titles.columns if c not in TITLE_COLUMNS]
    return (titles.filter(F.col("box_office").isNotNull())
            .select(*[F.col(quoted(c)) for c in extra], *TITLE_COLUMNS,
                    bucket_label("budget", budget_cuts, budget_labels).alias("budget_category"),
                    bucket_label("roi", roi_cuts, roi_labels).alias("roi_category")))


def staged_titles_sql(table: str, budget_cuts: Sequence[float] = BUDGET_CUTS, roi_cuts: Sequence[float] = ROI_CUTS,
                      budget_labels: Sequence[str] = BUDGET_LABELS, roi_labels: Sequence[str] = ROI_LABELS, keep: Sequence[str] = ()) -> str:
    """``staged_titles`` as the text of a view, its cut points included."""
    def tier(c: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
        arms = " ".join(f"WHEN {c} < {cut} THEN '{label}'" for cut, label in zip(cuts, labels))
        return f"CASE {arms} ELSE '{labels[-1]}' END"

    columns = ", ".join([*map(quoted, keep), *TITLE_COLUMNS])
    return (f"SELECT {columns}, {tier('budget', budget_cuts, budget_labels)} AS budget_category, "
            f"{tier('roi', roi_cuts, roi_labels)} AS roi_category FROM {table} WHERE box_office IS NOT NULL")


def staged_tags_sql(table: str) -> str:
    return f"SELECT title, genre FROM {table}"


def staged_tags(tags: DataFrame) -> DataFrame:
    """Pass-through projection of the child table."""
    return tags.select("title", "genre")
