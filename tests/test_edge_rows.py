"""Golden edge rows (one per cleaning / null / rounding / ranking rule)."""

from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions.tiers import bucket_label, BUDGET_CUTS, BUDGET_LABELS, ROI_CUTS, ROI_LABELS
from marquee.operators import audit, clean, marts, staging
from marquee.operators.verify import roi_top

BASE = {"title": "T", "budget": "100", "box_office": "200", "country": "C"}


def tags_of(raw, genre):
    df = clean.normalize_tags(raw(dict(BASE, genre=genre)))
    return [r.genre for r in df.collect()]


def test_tag_typos_fixed_in_order(raw):
    assert tags_of(raw, "Action, Horor, Mistery") == ["Action", "Horror", "Mystery"]


def test_tag_dedup_after_correction(raw):
    assert tags_of(raw, "War Drama,Drama ,Drama") == ["Drama"]


def test_null_tag_list_gives_no_rows(raw):
    assert tags_of(raw, None) == []
    assert tags_of(raw, "NA") == []


def test_empty_piece_kept_then_rejected(raw):
    assert tags_of(raw, "Drama,,X") == ["Drama", "", "X"]
    tags = clean.normalize_tags(raw(dict(BASE, genre="Drama,,X")))
    good, bad = audit.split_valid(tags, audit.tag_rules())
    assert [r.genre for r in good.collect()] == ["Drama", "X"]
    assert [r.reason for r in bad.collect()] == ["genre_null_or_empty"]


def test_lookup_is_case_exact(raw):
    assert tags_of(raw, "horor") == ["horor"]


def _titles(raw, *rows):
    return clean.clean_titles(raw(*rows), keep=("k",)) if rows and "k" in rows[0] else \
        clean.clean_titles(raw(*rows))


def test_bad_money_text_is_null(raw):
    vals = ["unknown", "Unknown", "1,000", "$5", "12d", "nan", "inf"]
    df = clean.clean_titles(raw(*[dict(BASE, box_office=v) for v in vals]))
    assert [r.box_office for r in df.collect()] == [None] * len(vals)


def test_loose_numbers_parse(raw):
    vals = [" 12 ", "1e6", "+5", "5."]
    df = clean.clean_titles(raw(*[dict(BASE, budget=v) for v in vals]))
    assert [r.budget for r in df.collect()] == [12, 1000000, 5, 5]


def test_float_to_int_rounds(raw):
    df = clean.clean_titles(raw(dict(BASE, duration="95.5"), dict(BASE, duration="94.4")))
    assert [r.duration for r in df.collect()] == [96, 94]


def test_zero_budget_roi_null(raw):
    df = clean.clean_titles(raw(dict(BASE, budget="0", box_office="10")))
    assert df.collect()[0].roi is None


def test_roi_half_even(raw):
    df = clean.clean_titles(raw(dict(BASE, budget="800", box_office="801")))
    assert df.collect()[0].roi == Decimal("0.12")


def test_null_budget_and_roi_fall_to_last_tier(raw):
    df = staging.staged_titles(clean.clean_titles(raw(dict(BASE, budget=None))))
    r = df.collect()[0]
    assert (r.budget_category, r.roi_category) == ("Blockbuster", "Exceptional Return")


def test_budget_tiers(spark):
    df = spark.createDataFrame([(9999999,), (10000000,), (50000000,), (150000000,)], "b bigint")
    got = [r.t for r in df.select(bucket_label("b", BUDGET_CUTS, BUDGET_LABELS).alias("t")).collect()]
    assert got == ["Low Budget", "Mid Budget", "High Budget", "Blockbuster"]


def test_roi_tiers(spark):
    df = spark.createDataFrame([(Decimal("-0.01"),), (Decimal("0"),), (Decimal("100"),), (Decimal("500"),)],
                               "r decimal(10,2)")
    got = [r.t for r in df.select(bucket_label("r", ROI_CUTS, ROI_LABELS).alias("t")).collect()]
    assert got == ["Loss", "Low Return", "Good Return", "Exceptional Return"]


def test_unicode_strip(raw):
    df = clean.clean_titles(raw(dict(BASE, title=" \tMy Film  \x1c", director=" D ")))
    r = df.collect()[0]
    assert (r.title, r.director) == ("My Film", "D")


def test_none_title_is_null_and_rejected(raw):
    titles = clean.clean_titles(raw(dict(BASE, title="None")), audit=True)
    good, bad = audit.split_valid(titles, audit.title_rules())
    assert good.count() == 0
    assert [r.reason for r in bad.collect()] == ["title_null"]


def test_repeated_title_fans_out(raw):
    rows = raw(dict(BASE, title="A1", genre="A", box_office="300", budget="100"),
               dict(BASE, title="A1", genre="A,B", box_office="500", budget="100"))
    titles, tags = clean.transform(rows)
    assert sorted(r.genre for r in tags.collect()) == ["A", "A", "B"]
    st = staging.staged_titles(titles)
    gm = {r.genre: r for r in marts.genre_mart(st, tags).collect()}
    # each of the 2 films is joined to both 'A' rows: 4 join rows
    assert gm["A"].movie_count == 1
    assert gm["A"].total_box_office == 2 * (300 + 500)
    assert gm["A"].avg_box_office == 400
    assert gm["B"].total_box_office == 800
    top = marts.top_titles_mart(st, tags).collect()
    assert {r.genres for r in top} == {"A, A, B"}


def test_tag_without_box_office_absent(raw):
    rows = raw(dict(BASE, title="X", genre="Lost", box_office="unknown"),
               dict(BASE, title="Y", genre="Kept", box_office="5"))
    titles, tags = clean.transform(rows)
    got = {r.genre for r in marts.genre_mart(staging.staged_titles(titles), tags).collect()}
    assert got == {"Kept"}


def test_rank_ties_share_and_skip(raw):
    rows = raw(dict(BASE, title="a", genre="G1", box_office="10"),
               dict(BASE, title="b", genre="G2", box_office="10"),
               dict(BASE, title="c", genre="G3", box_office="5"))
    titles, tags = clean.transform(rows)
    for impl in ("window", "global"):
        ranks = {r.genre: r.revenue_rank
                 for r in marts.genre_mart(staging.staged_titles(titles), tags, impl).collect()}
        assert ranks == {"G1": 1, "G2": 1, "G3": 3}


def test_null_country_is_a_group(raw):
    rows = raw(dict(BASE, country=None), dict(BASE, country="NA"), dict(BASE, country="X"))
    cm = marts.country_mart(staging.staged_titles(clean.clean_titles(rows)))
    got = {r.country: r.movie_count for r in cm.collect()}
    assert got == {None: 2, "X": 1}


def test_roi_top_nulls_first_and_last(raw):
    rows = raw(*[dict(BASE, k=str(i), budget="100", box_office=str(100 + i)) for i in range(1, 7)],
               dict(BASE, k="0", budget="0", box_office="5"), extra=("k",))
    titles = clean.clean_titles(rows, keep=("k",))
    first = [r.roi for r in roi_top(titles, 5, "first", tie="k").collect()]
    last = [r.roi for r in roi_top(titles, 5, "last", tie="k").collect()]
    assert first[0] is None and first[1] == Decimal("6.00")
    assert last == [Decimal(x) for x in ("6.00", "5.00", "4.00", "3.00", "2.00")]


def test_roi_overflow_null_and_counted(raw):
    titles = clean.clean_titles(raw(dict(BASE, budget="1", box_office="2000000000")), audit=True)
    assert titles.collect()[0].roi is None
    counts = {(r.table_name, r.reason): r.rejected_rows
              for r in audit.reject_reasons(titles, clean.normalize_tags(raw(dict(BASE)))).collect()}
    assert counts[("movies", "roi_out_of_range")] == 1


def test_exact_average_no_double_rounding(spark):
    # 1,499,999 values of 0.01 and 1,500,001 of 0.00 average 0.0049999...: exact answer 0.00
    from marquee.functions.numeric import exact_avg_cents, exact_avg_int
    df = spark.createDataFrame([(1499999, 3000000, 2999999, 2)], "s long, n long, t long, m long")
    r = df.select(exact_avg_cents("s", "n").alias("a"), exact_avg_int("t", "m").alias("b"),
                  exact_avg_int(F.lit(-3), F.lit(2)).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == (Decimal("0.00"), 1500000, -2)


def test_tag_string_collation_option(raw):
    tags = clean.normalize_tags(raw(dict(BASE, genre="b,Sci-Fi,Action")))
    binary = marts.ordered_tag_string(tags).collect()[0].genres
    unicode = marts.ordered_tag_string(tags, collation="UNICODE").collect()[0].genres
    assert binary == "Action, Sci-Fi, b"
    assert unicode == "Action, b, Sci-Fi"


def test_float_round_matches_numpy(spark):
    import numpy as np
    from marquee.functions.numeric import round_float
    rnd = np.random.default_rng(1)
    vals = [1.015, 2.675, 0.125, -1.005, 1234.565, 0.285] + list(rnd.uniform(-1e4, 1e4, 2000).round(3))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r.y for r in df.select(round_float("x", 2).alias("y")).collect()]
    assert got == [float(v) for v in np.around(np.array(vals, dtype=float), 2)]
    got1 = [r.y for r in df.select(round_float("x", 1).alias("y")).collect()]
    assert got1 == [float(v) for v in np.around(np.array(vals, dtype=float), 1)]
