"""Ranking over a whole table.

``rank_window`` is SQL ``rank() over (order by c desc)``. Without a
PARTITION BY, Spark moves every row into one task, so use it only on inputs
whose row count is bounded by a dimension (one row per genre or country).

``global_rank`` gives the same numbers for inputs and keys of any size and
any sortable type:

1. collapse equal keys: ``(key, n)`` per distinct value, so a hot value is
   one row (partial aggregation before the shuffle);
2. ``repartitionByRange`` on the key in rank order; the ranges are written
   once with their number, so all later steps see the same ones;
3. inside each range, rows ahead = running sum of ``n`` over a window
   partitioned by range;
4. rows in earlier ranges = running sum over the per-range totals, a table of
   one row per shuffle partition, so its broadcast has a proven size bound;
5. rank = 1 + both counts; joined back to the rows on the key (null-safe).

Equal keys always share a range, so ties share a rank and the next rank
skips, exactly as ``rank()``. NULL keys rank after every value (NULLS LAST).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir


def rank_window(df: DataFrame, order_col: str, out: str = "rank", desc: bool = True) -> DataFrame:
    o = F.col(order_col).desc_nulls_last() if desc else F.col(order_col).asc_nulls_last()
    return df.withColumn(out, F.rank().over(Window.orderBy(o)))


def global_rank(df: DataFrame, order_col: str, out: str = "rank", desc: bool = True,
                ranges: int | None = None, stage_input: bool = False) -> DataFrame:
    """``rank()`` by ``order_col`` (long result) without a single-task step.

    ``ranges`` is the number of ranges (default: the session's shuffle
    partitions). ``stage_input=True`` first checkpoints the input, so a long
    upstream plan runs once for the keys and the rows."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if stage_input:
        df = df.checkpoint()
    ranges = max(1, ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    key = F.col(order_col)
    order = key.desc_nulls_last() if desc else key.asc_nulls_last()
    keys = (df.groupBy(order_col).agg(F.count(F.lit(1)).alias("_n"))
            .repartitionByRange(ranges, order).withColumn("_b", F.spark_partition_id()).checkpoint())
    in_range = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    keyed = keys.withColumn("_before_in", F.coalesce(F.sum("_n").over(in_range), F.lit(0)))
    totals = keys.groupBy("_b").agg(F.sum("_n").alias("_tot"))
    prior = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before_out", F.coalesce(F.sum("_tot").over(prior), F.lit(0)))
    ranks = (keyed.join(F.broadcast(totals.select("_b", "_before_out")), "_b")
             .select(key.alias("_k"),
                     (F.lit(1) + F.col("_before_in") + F.col("_before_out")).cast("bigint").alias(out)))
    return df.join(ranks, df[order_col].eqNullSafe(ranks["_k"]), "inner").drop("_k")
