"""Data audits: null counts, row counts, load rules and rejects.

Every audit is one aggregate pass (count_if per rule) instead of one
``count()`` job per number; long-format outputs come from ``unpivot`` of
that single row, not from joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.clean import TITLE_COLUMNS

# The reference store's column limits (VARCHAR sizes) and
# NOT NULL columns; decimal(10,2) range for ROI.
TITLE_LIMITS = {"title": 300, "director": 200, "language": 100, "country": 100}
TAG_LIMITS = {"title": 300, "genre": 100}


def title_rules(limits: Mapping[str, int] = TITLE_LIMITS) -> dict[str, Column]:
    """reason -> condition that rejects a title row."""
    rules = {"title_null": F.col("title").isNull()}
    for c, n in limits.items():
        rules[f"{c}_too_long"] = F.length(c) > n
    return rules


def tag_rules(limits: Mapping[str, int] = TAG_LIMITS) -> dict[str, Column]:
    """A tag row needs a title and a non-empty tag (an empty piece becomes
    NULL on a CSV hand-off and would break the NOT NULL column)."""
    rules = {"title_null": F.col("title").isNull(),
             "genre_null_or_empty": F.col("genre").isNull() | (F.col("genre") == "")}
    for c, n in limits.items():
        rules[f"{c}_too_long"] = F.length(c) > n
    return rules


def first_reason(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule that a row breaks; NULL if none."""
    expr = None
    for reason, cond in rules.items():
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, reason) if expr is None else expr.when(cond, reason)
    return expr if expr is not None else F.lit(None).cast("string")


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows passing every rule, rejected rows with the first failing
    ``reason``). Both sides derive from one tagged projection; cache or
    checkpoint ``df`` upstream when both are written."""
    tagged = df.withColumn("_reason", first_reason(rules))
    good = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def rule_counts(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """(table_name, reason, rejected_rows): rows failing each rule, counted
    independently, in one aggregate pass."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in rules.items()])
    return (row.unpivot([], list(rules), "reason", "rejected_rows")
            .select(F.lit(table).alias("table_name"), "reason", "rejected_rows"))


def reject_reasons(titles: DataFrame, tags: DataFrame) -> DataFrame:
    """Rule counts for both tables, plus ROI values outside decimal(10,2)
    (needs ``clean_titles(..., audit=True)`` input for the raw ROI)."""
    t_rules = title_rules()
    if "roi_unbounded" in titles.columns:
        t_rules["roi_out_of_range"] = roi_out_of_range()
    return rule_counts(titles, t_rules, "movies").unionByName(
        rule_counts(tags, tag_rules(), "movie_genres"))


def roi_out_of_range() -> Column:
    return F.col("roi").isNull() & F.col("roi_unbounded").isNotNull()


def reject_reasons_one_pass(wide: DataFrame, tag_list: str = "genre_list") -> DataFrame:
    """``reject_reasons`` from ``clean_wide(..., audit=True)`` rows in one
    aggregate: the rules of the tag rows count inside the list."""
    def n(cond_of_tag) -> Column:
        return F.coalesce(F.size(F.filter(F.col(tag_list), lambda x: F.coalesce(cond_of_tag(x), F.lit(False)))), F.lit(0)).cast("bigint")

    title = F.col("title")
    sums = {("movies", r): F.coalesce(c, F.lit(False)).cast("bigint") for r, c in {**title_rules(), "roi_out_of_range": roi_out_of_range()}.items()}
    sums[("movie_genres", "title_null")] = n(lambda x: title.isNull())
    sums[("movie_genres", "genre_null_or_empty")] = n(lambda x: x.isNull() | (x == ""))
    sums[("movie_genres", "title_too_long")] = n(lambda x: F.length(title) > TAG_LIMITS["title"])
    sums[("movie_genres", "genre_too_long")] = n(lambda x: F.length(x) > TAG_LIMITS["genre"])
    rows = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(r).alias("reason"), F.coalesce(F.sum(c), F.lit(0)).alias("rejected_rows"))
                     for (t, r), c in sums.items()])
    return wide.agg(rows.alias("rows")).select(F.inline("rows"))


def null_audit(df: DataFrame, columns: Sequence[str] = TITLE_COLUMNS) -> DataFrame:
    """One row: total rows and NULL count of each column, one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def transform_summary(titles: DataFrame, tags: DataFrame, tag: str = "genre",
                      approx: bool = False) -> DataFrame:
    """(metric, value): the cleaning step's log line numbers, one aggregate
    per table. ``unique_tags`` is an exact distinct count (partial
    aggregation on the tag, so it shuffles at most the distinct tags), or a
    HyperLogLog++ estimate with ``approx=True`` (fixed-size state)."""
    t = titles.agg(F.count(F.lit(1)).alias("movies_rows"),
                   F.count_if(F.col("box_office").isNull()).alias("null_box_office"),
                   F.count_if(F.col("budget").isNull()).alias("null_budget"))
    g = tags.agg(F.count(F.lit(1)).alias("tag_rows"),
                 (F.approx_count_distinct(tag) if approx else F.count_distinct(tag)).alias("unique_tags"))
    return (t.unpivot([], t.columns, "metric", "value")
            .unionByName(g.unpivot([], g.columns, "metric", "value")))


def transform_summary_one_pass(wide: DataFrame, tag_list: str = "genre_list") -> DataFrame:
    """``transform_summary`` from ``clean_wide`` rows in one pass: each row's
    numbers go with its first tag row (``explode_outer`` keeps rows without
    tags), rows are combined by tag before the shuffle, and the few tag groups
    are summed."""
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    rows = wide.select("box_office", "budget", F.posexplode_outer(tag_list).alias("pos", "tag"))
    by_tag = rows.groupBy("tag").agg(
        F.count_if(first).alias("movies_rows"), F.count_if(first & F.col("box_office").isNull()).alias("null_box_office"),
        F.count_if(first & F.col("budget").isNull()).alias("null_budget"), F.count("pos").alias("tag_rows"))
    metrics = ("movies_rows", "null_box_office", "null_budget", "tag_rows")
    out = by_tag.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in metrics], F.count("tag").alias("unique_tags"))
    return out.unpivot([], out.columns, "metric", "value")


def row_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, row_count) for each named frame."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def footer_row_counts(**tables: DataFrame) -> DataFrame:
    """``row_counts`` of frames from ``sources.tables.read_for_counts``: the
    counts come from the files' footers. Spark's pushed count of a table
    without rows is NULL, so each is added to a zero."""
    out = None
    for name, df in tables.items():
        n = df.agg(F.count(F.lit(1)).alias("n"))
        zero = df.sparkSession.range(1).select((F.col("id") * 0).alias("n"))
        one = n.unionByName(zero).agg(F.sum("n").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def duplicate_titles(titles: DataFrame, key: str = "title") -> DataFrame:
    """(title, copies) for every title held by more than one row: the rows
    whose tags and money the title join multiplies (each copy is joined to
    every tag row of the title). Partial aggregation before the shuffle, so a
    hot title is a handful of rows per task."""
    return (titles.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (sorted at read by the caller)."""
    return df.select(column).distinct()
