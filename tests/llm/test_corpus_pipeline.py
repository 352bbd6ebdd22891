"""The pipeline's stages: whole work, decisions that take effect, clean documents kept."""

import random

import corpus_pipeline
from marquee.llm import suffix


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ka", "lo", "mi", "su", "te", "ra", "en", "do"]) for _ in range(r.randrange(1, 5))) for _ in range(n))


def rows():
    lines = "\n".join(words(k, 9) for k in range(900, 906))
    out = [(k, words(k, 90), "en" if k % 3 else None, "s", 0) for k in range(30)]
    out += [(40, words(3, 90), "en", "s", 0), (41, words(4, 90) + " more", "en", "s", 0), (42, "12 34 !!", "en", "s", 0), (43, None, "en", None, None),
            (44, lines + "\n" + words(44, 40), "en", "s", 0), (45, words(45, 40) + "\n" + lines, "en", "s", 0), (46, words(46, 60) + " " + words(7, 30) + " " + words(47, 60), "en", "s", 0)]
    return out


def staged(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    found = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "unused").write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        found.append(docs)
    return found


def test_stages(spark, tmp_path):
    language, lines, near, cut, packed = staged(spark, tmp_path)
    for df in (language, lines, near, cut):
        assert tuple(df.columns) == corpus_pipeline.COLUMNS
        assert all(r["n_chars"] == len(r["text"]) for r in df.collect())
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    assert ids(language) == {r[0] for r in rows()} - {42, 43}
    by = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert by[45] == words(45, 40) and by[44] == rows()[34][1] and by[3] == words(3, 90)
    assert ids(near) == ids(lines) - {40, 41}
    after = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert set(after) == ids(near) and all(after[k] == words(k, 90) for k in range(30))
    before = {r["doc_id"]: (r["text"] or "").encode() for r in near.collect()}
    held = {}
    for i in sorted(before):
        for p in range(len(before[i]) - suffix.LENGTH + 1):
            held.setdefault(before[i][p:p + suffix.LENGTH], i)
    for i, raw in before.items():
        gone = [False] * len(raw)
        for p in range(len(raw) - suffix.LENGTH + 1):
            if held[raw[p:p + suffix.LENGTH]] < i:
                gone[p:p + suffix.LENGTH] = [True] * suffix.LENGTH
        assert after[i].encode() == bytes(b for b, g in zip(raw, gone) if not g)
    assert {r["doc_id"] for r in packed.collect()} == set(after)


def test_run_leaves_the_last_stage_only(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns)


def test_suffix_stage_handles_broken_characters(spark):
    text = "é" * 40
    docs = spark.createDataFrame([(1, "x" + text, "en", "s", 1), (2, "tail " + text, "en", "s", 1), (3, "x" + text, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in suffix.without_repeats(docs).collect()}
    assert got == {1: "x" + text, 2: "tail "}
