"""Properties on the driver tables: pre-aggregated mart equals the plain
n*m join (test-only brute force), totals add up, tag strings round-trip."""

from collections import Counter

import pytest

from pyspark.sql import functions as F

from marquee.functions.numeric import exact_avg_cents, exact_avg_int
from marquee.plans.catalog import Catalog

SF = "/root/testdata/sf0.001"


def test_preaggregated_genre_mart_equals_plain_join(spark):
    c = Catalog(spark, SF)
    m, g = c.staged, c.tags
    plain = (g.select("title", "genre").join(m, "title", "left").filter(F.col("box_office").isNotNull())
             .groupBy("genre").agg(
                 F.count_distinct("title").alias("movie_count"),
                 exact_avg_int(F.sum(F.col("budget").cast("decimal(38,0)")), F.count("budget")).alias("avg_budget"),
                 exact_avg_int(F.sum(F.col("box_office").cast("decimal(38,0)")), F.count("box_office")).alias("avg_box_office"),
                 exact_avg_cents(F.sum((F.col("roi") * 100).cast("decimal(38,0)")), F.count("roi")).alias("avg_roi"),
                 F.sum("box_office").alias("total_box_office")))
    want = {r.genre: tuple(r)[1:] for r in plain.collect()}
    got = {r.genre: tuple(r)[1:6] for r in c.genre_mart().collect()}
    assert got == want


def test_country_totals_add_up(spark):
    c = Catalog(spark, SF)
    total = c.staged.agg(F.sum("box_office")).collect()[0][0]
    assert c.country_mart().agg(F.sum("total_box_office")).collect()[0][0] == total


def test_tag_string_round_trips(spark):
    c = Catalog(spark, SF)
    strings = {r.title: Counter(r.genres.split(", ")) for r in c.ordered_tag_string.collect()}
    rows = Counter((r.title, r.genre) for r in c.tags.collect())
    back = Counter()
    for t, cnt in strings.items():
        for g, n in cnt.items():
            back[(t, g)] += n
    assert back == rows
    assert all(s.split(", ") == sorted(s.split(", ")) for s in
               (r.genres for r in c.ordered_tag_string.collect()))


def test_global_rank_marts_equal_window(spark):
    c = Catalog(spark, SF)
    for a, b in ((c.genre_mart(), c.genre_mart("global")), (c.country_mart(), c.country_mart("global"))):
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_materialized_catalog_equals_lazy(spark):
    lazy, mat = Catalog(spark, SF), Catalog(spark, SF, materialize=True)
    for a, b in ((lazy.titles, mat.titles), (lazy.tags, mat.tags), (lazy.genre_mart(), mat.genre_mart())):
        assert a.columns == b.columns
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_hot_title_third_of_rows_matches_brute_force(spark, raw):
    import random
    from marquee.operators import clean, marts, staging
    rnd = random.Random(11)
    kinds = ["Drama", "Action", "Horor", "Comedy"]
    rows = []
    for i in range(240):
        title = "HOT" if i % 3 == 0 else f"t{i % 50}"
        box = "unknown" if i % 7 == 0 else str(rnd.randrange(1000, 9000))
        rows.append(dict(k=str(i), title=title, budget=str(rnd.randrange(0, 5000)), box_office=box,
                         country=f"c{i % 4}", genre=",".join(rnd.sample(kinds, rnd.randrange(1, 4)))))
    titles, tags = clean.transform(raw(*rows, extra=("k",)), keep=("k",))
    st = staging.staged_titles(titles)
    # brute force: the plain n*m join the reference writes
    plain = (tags.select("title", "genre").join(st, "title").groupBy("genre")
             .agg(F.count_distinct("title").alias("movie_count"),
                  F.sum("box_office").alias("total_box_office"),
                  exact_avg_int(F.sum(F.col("budget").cast("decimal(38,0)")), F.count("budget")).alias("avg_budget")))
    want = {r.genre: tuple(r)[1:] for r in plain.collect()}
    got = {r.genre: (r.movie_count, r.total_box_office, r.avg_budget)
           for r in marts.genre_mart(st, tags, "global").collect()}
    assert got == want
    hot = Counter(r.genre for r in tags.filter(F.col("title") == "HOT").collect())
    s = {r.title: r.genres for r in marts.ordered_tag_string(tags).collect()}["HOT"]
    assert Counter(s.split(", ")) == hot and s.split(", ") == sorted(s.split(", "))
    top = marts.top_titles_mart(st, tags, keep=("k",))
    assert top.count() == st.count()
    assert top.filter(F.col("title") == "HOT").select("genres").distinct().collect()[0][0] == s


def test_salted_lookup_join_equals_plain(spark, raw):
    import random
    from marquee.operators import clean, marts, staging
    from marquee.operators.skew import lookup_join
    rnd = random.Random(12)
    rows = [dict(k=str(i), title="HOT" if i % 3 == 0 else f"t{i % 40}", budget="10",
                 box_office=str(rnd.randrange(1, 999)), genre=rnd.choice(["A", "B,A", "C"]))
            for i in range(300)]
    titles, tags = clean.transform(raw(*rows, extra=("k",)), keep=("k",))
    st = staging.staged_titles(titles)
    plain = marts.top_titles_mart(st, tags, keep=("k",))
    salted = marts.top_titles_mart(st, tags, keep=("k",), salts=8)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    p = salted._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # equal rows of one key spread over the salts too
    same = spark.createDataFrame([("a", 1)] * 1000, "k string, v int")
    one = spark.createDataFrame([("a", 9)], "k string, w int")
    assert lookup_join(same, one, "k", salts=4).filter("w = 9").count() == 1000
    with pytest.raises(ValueError):
        lookup_join(same, one, "k", "full", salts=4)


def test_hot_title_is_counted_not_built(spark):
    from marquee.operators import marts
    tags = spark.range(2000).selectExpr("'HOT' AS title", "IF(id % 2 = 0, 'A', 'B') AS genre")
    compact = marts.title_tag_counts(tags).collect()
    assert [(p.tag, p.n) for p in compact[0].tag_counts] == [("A", 1000), ("B", 1000)]
    # beyond 2^31 rows the counts still stand; only the string can't be built
    huge = spark.sql("SELECT 'HOT' AS title, array(named_struct('tag', 'A', 'n', 2200000000L)) AS tag_counts")
    assert huge.select("tag_counts").collect()[0][0][0].n == 2_200_000_000
    with pytest.raises(Exception, match="OVERFLOW"):
        huge.select(marts.tag_string()).collect()


def test_table_dictionary_variant_equals_map_literal(spark):
    from marquee.operators import clean
    from marquee.plans.catalog import DEFAULT, KEY
    c = Catalog(spark, SF)
    d = spark.createDataFrame(list(DEFAULT.corrections.items()), "src string, dst string")
    got = clean.normalize_tags_with_table(c.raw, d, key=(KEY,))
    want = c.tags
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
