"""Link audit, one-pass type inference and mergeable distinct counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.operators import inference, links, sketches


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_links_both_ways_with_a_hot_orphan(spark):
    titles = [("a",), ("a",), ("b",), (None,), ("lonely",)]
    tags = [("a", "g")] * 3 + [("b", None)] + [("orphan", "g")] * 2000 + [(None, "g")] * 2 + [("other", "")]
    t, g = spark.createDataFrame(titles, "title string"), spark.createDataFrame(tags, "title string, genre string").repartition(7)
    expected = [("tags_without_title", None, 2), ("tags_without_title", "orphan", 2000), ("tags_without_title", "other", 1),
                ("titles_without_tag", None, 1), ("titles_without_tag", "lonely", 1)]
    assert rows(links.unlinked(t, g)) == sorted(expected, key=repr)
    assert rows(links.link_audit(t, g)) == [("tags_without_title", 2, 2003), ("titles_without_tag", 1, 2)]
    good, bad = links.split_linked(g, t)
    assert rows(good) == sorted([("a", "g")] * 3 + [("b", None)], key=repr)
    assert Counter(r["title"] for r in bad.collect()) == {"orphan": 2000, None: 2, "other": 1}
    plan = links.unlinked(t, g)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan       # one combined shuffle of distinct titles


def test_links_of_empty_tables(spark):
    t, g = spark.createDataFrame([], "title string"), spark.createDataFrame([], "title string, genre string")
    assert links.unlinked(t, g).collect() == []
    assert rows(links.link_audit(t, g)) == [("tags_without_title", 0, 0), ("titles_without_tag", 0, 0)]
    assert links.split_linked(g, t)[0].collect() == []


COLUMNS = {
    "ints": (["1", " 2 ", "+3", "-2147483648", None, "NA"], "int", 2, 0, "int"),
    "longs": (["1", "2147483648", "3"], "bigint", 0, 0, "bigint"),
    "huge": (["1", "92233720368547758080"], "double", 0, 0, "double"),
    "floats": (["1", "2.5", "1e3", ".5", "5."], "double", 0, 0, "double"),
    "dirty": (["1", "2", "unknown", "3", ""], "string", 1, 1, "int"),
    "half": (["1", "x", "2", "y"], "string", 0, 0, "string"),
    "dates": (["2020-01-31", "1999-12-01", "nan"], "date", 1, 0, "date"),
    "no date": (["2020-02-30", "1999-12-01"], "string", 0, 0, "string"),
    "truth": (["True", "false", "TRUE"], "boolean", 0, 0, "boolean"),
    "mixed": (["True", "1", "1"], "string", 0, 1, "int"),
    "mixed.dates": (["2020-01-31", "1", "2"], "string", 0, 1, "int"),
    "void": (["", None, "NULL"], "void", 3, 0, "void"),
    "text": (["a", "b", "12d", "1,000", "inf"], "string", 0, 0, "string"),
}


@pytest.fixture
def mixed(spark):
    n = max(len(v[0]) for v in COLUMNS.values())
    data = [tuple((v[0][i] if i < len(v[0]) else None) for v in COLUMNS.values()) for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in COLUMNS)).repartition(3)


def test_types_of_one_pass(spark, mixed):
    n = mixed.count()
    got = {r["column"]: tuple(r)[1:] for r in inference.inferred_types(inference.class_counts(mixed)).collect()}
    assert got == {c: (t, nulls + n - len(values), bad, clean) for c, (values, t, nulls, bad, clean) in COLUMNS.items()}
    plan = inference.class_counts(mixed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_counts_of_parts_add_up(spark, mixed):
    parts = [mixed.where(F.col("ints").isNull()), mixed.where(F.col("ints").isNotNull()), mixed.limit(0)]
    whole = inference.class_counts(mixed)
    assert rows(inference.merge_counts([inference.class_counts(p) for p in parts])) == rows(whole)


def test_frame_typed_by_its_own_types(spark, mixed):
    types = inference.inferred_types(inference.class_counts(mixed))
    out = inference.typed(mixed, types)
    assert dict(out.dtypes) | {"void": "string"} == {c: ("string" if v[4] == "void" else v[4]) for c, v in COLUMNS.items()}
    assert sorted(r["dirty"] for r in out.collect() if r["dirty"] is not None) == [1, 2, 3]
    assert dict(inference.typed(mixed, types, clean=False).dtypes)["dirty"] == "string"


def test_types_of_an_empty_table(spark):
    got = inference.inferred_types(inference.class_counts(spark.createDataFrame([], "a string, b string")))
    assert rows(got) == [("a", "void", 0, 0, "void"), ("b", "void", 0, 0, "void")]


def test_stored_sketches_merge_to_any_grouping(spark):
    rng = random.Random(3)
    data = [(rng.choice(["x", "y", None]), rng.choice([1999, 2000]), rng.choice("abcdef"), f"t{rng.randrange(30_000)}") for _ in range(60_000)]
    data += [("x", 2000, "hot", "same")] * 20_000
    df = spark.createDataFrame(data, "country string, release_year int, genre string, title string").repartition(6)
    stored = sketches.title_sketches(df)
    out = {(r["grouping"], r["value"]): r for r in sketches.accuracy(stored, df).collect()}
    assert all(r["within_bound"] for r in out.values()) and sketches.BOUND < 0.05
    assert out["genre", "hot"]["titles"] == 1 and out["genre", "hot"]["n_rows"] == 20_000
    assert ("country", None) in out and out["all", None]["n_rows"] == 80_000
    # two batches' sketches, stored apart, merge to the same estimates as one
    parts = sketches.title_sketches(df.where("release_year = 1999")).unionByName(sketches.title_sketches(df.where("release_year = 2000")))
    assert rows(sketches.merged_counts(parts)) == rows(sketches.merged_counts(stored))


def test_sketches_are_not_shuffled_per_task(spark):
    """Sketches are made behind the shuffle of distinct values, not in each task that reads rows; exact counts move no grouping's rows."""
    df = spark.createDataFrame([("x", 1999, "a", "t"), ("x", 1999, "a", "t"), ("x", 1999, "b", None), (None, None, None, None)],
                               "country string, release_year int, genre string, title string")
    made = sketches.title_sketches(df)
    plan = made._jdf.queryExecution().executedPlan().toString()
    between = plan[plan.index(" hll_sketch_agg("):plan.index("partial_hll_sketch_agg(")]
    assert "Exchange" not in between
    assert sorted(r["n_rows"] for r in made.collect()) == [1, 1, 2]
    out = {(r["grouping"], r["value"]): (r["n_rows"], r["titles"], r["within_bound"]) for r in sketches.accuracy(made, df).collect()}
    assert out["all", None] == (4, 1, True) and out["genre", "b"] == (1, 0, True) and out["country", None] == (1, 0, True)


def test_tags_are_trimmed_once(spark):
    from marquee.functions.tags import clean_tag_list
    from marquee.functions.text import WS_CHARS, strip
    texts = ["", " ", "a", " a", "a ", " a b\t", "a\x1c,b", *[f"{w}x{w}y{w}" for w in WS_CHARS], "\U0001f600 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip("t")).collect()] == [t if t is None else t.strip() for t in texts]
    plan = df.select(clean_tag_list("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(lambda") == 1
