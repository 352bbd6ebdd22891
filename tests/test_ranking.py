"""global_rank (range-bucketed, no single-task step) equals rank()."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators.ranking import global_rank


def _check(spark, values, desc=True, ranges=5):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")
    o = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
    want = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(o))).collect()}
    got = {r.id: r.r for r in global_rank(df, "v", "r", desc=desc, ranges=ranges).collect()}
    assert got == want


def test_random_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([None] + list(range(40))) for _ in range(400)]
    _check(spark, vals, True)
    _check(spark, vals, False)


def test_hot_value_holds_a_third(spark):
    rnd = random.Random(3)
    vals = [17 if i % 3 == 0 else rnd.randrange(1000) for i in range(600)]
    _check(spark, vals, True, ranges=8)


def test_single_bucket_and_empty(spark):
    _check(spark, [5, 5, 3, None], True, ranges=1)
    df = spark.createDataFrame([], "id long, v long")
    assert global_rank(df, "v", "r", ranges=4).count() == 0


def test_more_buckets_than_keys(spark):
    rnd = random.Random(5)
    _check(spark, [rnd.randrange(12) for _ in range(300)] + [None, None], True, ranges=1000)


def test_string_date_and_infinite_keys(spark):
    import datetime
    rnd = random.Random(11)
    columns = {
        "string": [rnd.choice(["", "a", "B", "zz", "é", None]) for _ in range(80)],
        "date": [rnd.choice([None, datetime.date(2020, 1, rnd.randrange(1, 9))]) for _ in range(80)],
        "double": [rnd.choice([float("inf"), float("-inf"), 1.5, None]) for _ in range(80)],
    }
    for kind, values in columns.items():
        df = spark.createDataFrame(list(enumerate(values)), f"id long, v {kind}")
        for desc in (True, False):
            o = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
            want = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(o))).collect()}
            assert {r.id: r.r for r in global_rank(df, "v", "r", desc=desc, ranges=4).collect()} == want
    infinite = spark.createDataFrame([(1, float("inf")), (2, float("inf"))], "id long, v double")
    assert [r.r for r in global_rank(infinite, "v", "r", ranges=4).collect()] == [1, 1]
