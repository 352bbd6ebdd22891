"""Operators on documents against brute force, with awkward rows."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marquee.llm import bpe, html, jaccard, langid, line_dedup, packing, pii, quality, suffix, url_filter
from marquee.llm.common import components
from marquee.llm.queries import pretoken_pattern, tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, key string, _text string, n_words string"


def frame(spark, rows):
    """(doc_id, text[, source]) rows; the other columns have names that operators use inside."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", "k", "t", "w") for r in rows], SCHEMA)


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def awkward():
    base = words(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    far = " ".join(base.split()[:60]) + " " + words(2, 60)
    lines = "\n".join(words(k, 12) for k in range(3, 9))
    return [(1, base), (2, near), (3, far), (4, base), (5, None), (6, ""), (7, "one two"), (8, "One TWO"), (9, "a b c d e"), (10, "\n\n \t"),
            (11, lines), (12, "intro\n" + lines + "\nend"), (13, base), (13, base), (None, near), (14, "x" * 300), (15, "y" + "x" * 299),
            (16, "é" * 100 + base), (17, " ".join([base] * 40)), (18, words(30, 5000)), (19, words(31, 40) + "\n" + lines)]


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    big = 1 << 62
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = defaultdict(lambda: big)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], big if r[0] is None else r[0])
    return sorted((big if r[0] is None else r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows))


def test_ngram_jaccard(spark):
    rows = awkward()
    r = random.Random(5)
    for g in range(4):  # groups of near copies whose members don't all link directly
        w = words(50 + g, 80).split()
        for k in range(12):
            for _ in range(2):
                w = list(w)
                w[r.randrange(len(w))] = f"e{r.randrange(9)}"
            rows.append((100 + 20 * g + k, " ".join(w)))
    got = jaccard.similar_groups(frame(spark, rows)).collect()
    big = 1 << 62
    real = lambda x: big if x is None else x
    assert sorted((real(g["id"]), g["n_shingles"], real(g["component_id"])) for g in got) == brute_groups(rows)
    kept = Counter(g["component_id"] for g in got if g["kept"] and g["n_shingles"])
    assert set(kept) == {g["component_id"] for g in got if g["n_shingles"]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_near_the_limit(spark, seed):
    """Cut, lengthened and changed copies around a similarity of 0.75, and parts that several groups share."""
    r = random.Random(seed)
    rows = []
    shared = [words(1000 + k, 30, 5000).split() for k in range(4)]
    for g in range(12):
        w = words(100 * seed + g, 70, 5000).split() + shared[g % 4]
        for k in range(9):
            t = list(w)
            t = t[r.randrange(1 + len(t) // 5):] if k % 3 == 0 else t + words(r.randrange(999), r.randrange(len(t) // 4), 300).split() if k % 3 == 1 else t
            for _ in range(r.randrange(5)):
                t[r.randrange(len(t))] = f"w{r.randrange(300)}"
            rows.append((10 * len(rows), " ".join(t)))
    got = jaccard.similar_groups(frame(spark, rows)).collect()
    assert sorted((g["id"], g["n_shingles"], g["component_id"]) for g in got) == brute_groups(rows)


def test_template_with_own_filler_makes_no_pairs(spark, monkeypatch):
    """A third of the rows are one template of 78 % and filler that is shared here and there: too unlike to link,
    and not paired with each other."""
    template, pool = words(1, 156, 5000), [words(500 + k, 11, 5000) for k in range(60)]
    rows = [(k, f"{pool[k % 60]} {template} {pool[(7 * k + k // 60) % 60]} {pool[(11 * k + 3 + k // 60) % 60]} {pool[(13 * k + 5) % 60]}") for k in range(240)]
    rows += [(1000 + k, words(3000 + k, 150, 5000)) for k in range(480)]
    made = []
    links = jaccard.Join.links

    def counted(self, pairs):
        made.append(pairs.count())
        return links(self, pairs)
    monkeypatch.setattr(jaccard.Join, "links", counted)
    got = jaccard.similar_groups(frame(spark, rows)).collect()
    assert sorted((g["id"], g["n_shingles"], g["component_id"]) for g in got) == brute_groups(rows)
    assert sum(made) < 3 * len(rows), made


def brute_cut(rows, length=50):
    held = defaultdict(lambda: 1 << 62)
    data = [((1 << 62) if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for i, raw in data:
        for p in range(len(raw) - length + 1):
            held[raw[p:p + length]] = min(held[raw[p:p + length]], i)
    out = []
    for i, raw in data:
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if held[raw[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark):
    rows = awkward() + [(40, "abc" * 90), (41, "zabc" + "abc" * 50), (42, "z" * 49), (43, "z" * 50), (44, "z" * 51), (45, "z" * 200)]
    got = suffix.suffix_dedup(frame(spark, rows)).collect()
    assert sorted(((1 << 62) if g["id"] is None else g["id"], g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) for g in got) == brute_cut(rows)


def test_hot_passage_fills_no_bucket(spark, monkeypatch):
    # 40 bytes that all documents hold between words of their own; some share more than that, once or often
    passage, r = "by our correspondent at www.example.org/ ", random.Random(9)
    own = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    shared = own(30)
    rows = [(k, own(70) + passage + own(70)) for k in range(400)] + [(k, own(40) + shared + passage + own(40)) for k in range(400, 410)]
    rows += [(420, "".join(own(60) + passage for _ in range(200))), (421, "x" * 4000), (422, "y" + "x" * 3000)]
    sort, most = suffix._answer_contexts, 9000

    def bounded(f):
        assert sum(map(len, f["contexts"])) < most, "one task gets a whole passage's surroundings"
        return sort(f)
    monkeypatch.setattr(suffix, "_answer_contexts", bounded)
    monkeypatch.setattr(suffix, "HOT_BYTES", 2000, raising=False)
    got = suffix.suffix_dedup(frame(spark, rows)).collect()
    assert sorted((g["id"], g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) for g in got) == brute_cut(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\0é", max_size=90), max_size=8), st.sampled_from([8, 11, 50]))
def test_suffix_order_finds_smallest_ids(texts, length):
    strings = [t.encode() for t in texts]
    ids = np.array([(7 * k) % 5 for k in range(len(strings))], np.int64)
    held = {}
    for s, i in zip(strings, ids):
        for p in range(len(s) - length + 1):
            held[s[p:p + length]] = min(held.get(s[p:p + length], 99), i)
    expected = [held[s[p:p + length]] for s in strings for p in range(len(s) - length + 1)]
    assert suffix.smallest_ids(strings, ids, length).tolist() == expected


def test_line_dedup(spark):
    rows = awkward()
    got = line_dedup.drop_repeated_lines(frame(spark, rows)).collect()
    big = 1 << 62
    seen, gone = {}, {}
    order = sorted(range(len(rows)), key=lambda k: big if rows[k][0] is None else rows[k][0])
    for k in order:
        i = big if rows[k][0] is None else rows[k][0]
        lines = rows[k][1].split("\n") if rows[k][1] else []
        cut = set()
        for p in range(len(lines) - 2):
            if any(lines[p:p + 3]) and seen.setdefault(tuple(lines[p:p + 3]), (i, p)) != (i, p):
                cut |= {p, p + 1, p + 2}
        gone[k] = (i, len(cut), "\n".join(x for j, x in enumerate(lines) if j not in cut) if rows[k][1] is not None else None)
    assert sorted(map(str, gone.values())) == sorted(str((big if g["doc_id"] is None else g["doc_id"], g["n_removed"], g["text"])) for g in got)
    assert {g["key"] for g in got} == {"k"} and {g["_text"] for g in got} == {"t"}  # other columns pass through


def test_quality_rules(spark):
    boiler = "Copyright notice of  this Site\nall rights are reserved here"
    rows = [(k, words(k, 60) + "\n" + boiler.upper() * (k % 2) + boiler * (1 - k % 2), "a") for k in range(12)]
    rows += [(50 + k, boiler + "\nfew own words " + words(k, 18), "a") for k in range(3)] + [(60, " ".join([words(9, 10)] * 9), "b"), (61, None, "b"), (62, "", None),
                                                                                             (63, words(9, 30) + " # $", None), (60, "a\na\n\na ", "b")]
    got = quality.quality_rules(frame(spark, rows), with_text=True).collect()
    assert len(got) == len(rows)
    by = {g["doc_id"]: g for g in got if g["doc_id"] != 60}
    assert all(by[k]["kept"] and by[k]["n_common_words"] == 10 and "ights" not in by[k]["clean_text"].lower() for k in range(12))
    assert by[61]["n_words"] == 0 and by[61]["base_failed"] and by[61]["clean_text"] is None and not by[62]["kept"]
    assert by[63]["n_symbols"] == 2 and by[63]["kept"]
    sixty = sorted((g["n_words"], g["n_repeat_words"], g["n_dup_lines"], g["base_failed"]) for g in got if g["doc_id"] == 60)
    assert sixty == [(3, 0, 1, True), (90, 90, 0, True)]
    depleted = quality.quality_rules(frame(spark, [(k, boiler + "\n" + words(k, 12), "c") for k in range(20)])).collect()
    assert not any(g["kept"] for g in depleted) and not any(g["base_failed"] for g in depleted)


def texts_for_codecs():
    return ["", "it's  a\n\n test, I'LL go\t 123", "日本語テキスト🙂🙂 naïve Ça ΑΣ", "a" * 3000, "\0\x1c\x85 x", "<|endoftext|> y", " ̈a  İ", "!?" * 700, words(3, 800)]


def test_byte_bpe_matches_the_library(spark):
    import tiktoken

    path = tokenizer_file("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("t", pat_str=pretoken_pattern(), mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = list(enumerate(texts_for_codecs())) + [(100, None), (3, "a" * 3000)]
    df = frame(spark, rows)
    got = bpe.round_trip(df, path, pretoken_pattern(), keep=("doc_id", "key")).collect()
    expected = sorted((i, len(x), sha256(np.array(x, "<u4").tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest())
                      for i, t in rows for x in [library.encode_ordinary(t or "")])
    assert sorted((g["doc_id"], g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) for g in got) == expected
    encoded = bpe.encode_documents(df, path, pretoken_pattern())
    back = bpe.decode_documents(encoded, path, pretoken_pattern()).collect()
    assert sorted((b["doc_id"], bytes(b["decoded"])) for b in back) == sorted((i, (t or "").encode()) for i, t in rows)


def test_long_texts_go_slice_by_slice(monkeypatch):
    import tiktoken

    ranks = bpe.read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=pretoken_pattern(), mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, pretoken_pattern())
    monkeypatch.setattr(bpe.slices, "__defaults__", (37,))
    for text in ("It's  a b c\n d e1 f  g' h. i, j " * 40 + words(5, 300), "x" * 500, "a b" * 100, "é ü " * 60):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)
    raw = words(6, 400).encode()
    whole = np.repeat(*suffix.anchors(raw))
    monkeypatch.setattr(suffix, "SLICE_BYTES", 211)
    assert np.repeat(*suffix.anchors(raw)).tolist() == whole.tolist()


def test_perfect_hash_is_minimal():
    keys = [b"k%d" % i for i in range(3000)]
    h = bpe.PerfectHash(keys, list(range(3000)))
    assert [h.get(k) for k in keys] == list(range(3000)) and None not in h.keys
    assert h.get(b"other") is None and bpe.PerfectHash([], []).get(b"x") is None


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))    # as it is: the text of a special token is that token
    rows = list(enumerate(texts_for_codecs())) + [(100, None), (None, "null id"), (3, "a" * 3000), (101, words(4, 9000))] + [(200 + k, words(k, 30 * k)) for k in range(40)]
    got = packing.pack_documents(frame(spark, rows), tokenizer_file("word_bpe_49k.json"), with_ids=True).collect()
    docs = defaultdict(list)
    for g in got:
        docs[g["doc_id"]].append((g["piece"], g["start"], np.frombuffer(g["ids"], "<u4").tolist()))
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = [(k, s, ids[s:s + 2048]) for k, s in enumerate(range(0, len(ids), 2048))]
        assert all(p in docs[i] for p in pieces)
    sequences = defaultdict(list)
    for g in got:
        sequences[g["sequence_id"]].append((g["offset"], g["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(g["length"] for g in got)
    assert len(sequences) <= -(-total // 2048) + 1


PARTS = ["It's", " don'T", "Zoë", "ÀÉ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|endoftext|", "endoftext|>", "<|ENDOFTEXT|>", " ", "\n\t", "1234", "x", "!?.", "'", "'ll",
         "日本", "привет", "ª²½", "İ", "ß", "×÷", "\x1c", "\x85", "\xa0", "é", "🙂", "\x7f", "word", "WORD", "_", "Ⅷ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.text(max_size=12)), max_size=5))
def test_cached_ids_are_the_plain_calls(texts):
    cache = packing.WordCache.of(tokenizer_file("word_bpe_49k.json"))
    assert [np.frombuffer(x, "<u4").tolist() for x in cache.ids(texts)] == [cache.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_generations_of_the_cache(monkeypatch):
    cache = packing.WordCache(tokenizer_file("word_bpe_49k.json"))
    monkeypatch.setattr(cache, "LIMIT", 5000, raising=False)
    most = 0
    for k in range(60):
        text = f"common words {words(k, 20)} привет{k}"
        assert np.frombuffer(cache.ids([text])[0], "<u4").tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids
        most = max(most, len(cache.young) + len(cache.old))
    assert "common" in cache.young | cache.old and most < 100


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 30), max_size=25))
def test_bin_plan_uses_every_piece_once(histogram):
    plan = packing.plan_bins(histogram, 100)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 100 and times >= 1
        for x in pattern:
            used[x] += times
    assert used == Counter(histogram) and len(plan) <= sum(1 + 100 // x for x in histogram)


def test_best_filling_finds_the_exact_one():
    lengths = np.array([3, 5, 7, 11, 13])
    counts = {3: 1, 5: 1, 7: 1, 11: 1, 13: 1}
    assert sum(packing.best_filling(31, lengths, counts)) == 31
    assert sum(packing.best_filling(2, lengths, counts)) == 0


def test_bin_plan_of_many_short_pieces():
    assert packing.plan_bins({1: 5000}) == [([1] * 2048, 2), ([1] * 904, 1)]
    histogram = {1: 5000, 2: 3000, 3: 7, 2048: 4}
    plan = packing.plan_bins(histogram)
    assert sum((Counter({x: times * n for x, n in Counter(p).items()}) for p, times in plan), Counter()) == Counter(histogram)
    assert sum(times for _, times in plan) == 4 + -(-(5000 + 6000 + 21) // 2048)


LANGUAGES = {"aa": "ka lo mi su tera", "bb": "sch ung keit zwo pfer", "cc": "привет мир как дела"}


def spoken(lang, seed, n):
    r = random.Random(seed)
    parts = LANGUAGES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_language_id(spark):
    taught = [(1000 * k + i, spoken(lang, 100 * k + i, 40), lang) for k, lang in enumerate(LANGUAGES) for i in range(20)]
    labelled = spark.createDataFrame([*taught, (9, None, "aa"), (10, "ka lo", None)], "doc_id long, text string, lang string")
    model = langid.fit(labelled)
    assert model.languages == ["aa", "bb", "cc"]
    mixed = spoken("aa", 1, 30) + " " + spoken("bb", 2, 20) + " " + spoken("cc", 3, 10)
    rows = [(1, spoken("aa", 7, 50)), (2, spoken("bb", 8, 50)), (3, spoken("cc", 9, 50)), (4, None), (5, "123 !?"), (6, ""), (7, mixed), (8, "漢字"), (9, spoken("bb", 4, 30000)), (9, spoken("aa", 7, 50))]
    got = sorted(map(tuple, langid.identify(frame(spark, rows), model, spans=True).collect()))
    pred = {(g[0], g[1]) for g in got}
    assert pred == {(1, "aa"), (2, "bb"), (3, "cc"), (4, "und"), (5, "und"), (6, "und"), (7, "aa"), (8, "aa"), (9, "aa"), (9, "bb")}
    assert all(0 <= g[2] <= 1 for g in got) and all(g[2] == 0 for g in got if g[0] in (4, 5, 6, 8))
    spans = next(g for g in got if g[0] == 7)[3]
    assert [(s["lang"], s["words"]) for s in spans] == [("aa", 30), ("bb", 20), ("cc", 10)]
    untaught = langid.fit(labelled.where("false"))
    assert {r["lang_pred"] for r in langid.identify(frame(spark, rows), untaught).collect()} == {"und"}


def test_copies_count_once_in_the_sample(spark):
    """A language of one text is learned; a hot text is one row of the sample."""
    rows = [(k, spoken("aa", 5, 40), "aa") for k in range(3000)] + [(9000 + k, spoken("bb", k, 40), "bb") for k in range(300)]
    rows += [(20_000 + k, spoken("cc", 1, 30), "cc") for k in range(500)] + [(30_000 + k, spoken("cc", k, 30), "cc") for k in range(300)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = langid.fit(labelled, sample_rows=100)
    assert model.languages == ["aa", "bb", "cc"]
    tests = [(1, spoken("aa", 5, 40)), (2, spoken("bb", 777, 40)), (3, spoken("cc", 778, 40))]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame(spark, tests), model).collect()}
    assert got == {1: "aa", 2: "bb", 3: "cc"}
    # the same model whatever the copies
    once = langid.fit(labelled.dropDuplicates(["text", "lang"]), sample_rows=100)
    few = [(k, spoken(lang, 50 + k, 20)) for k, lang in enumerate(LANGUAGES)]
    predict = lambda m: sorted(map(tuple, langid.identify(frame(spark, few), m).collect()))
    assert predict(model) == predict(once)


CLASHING = [
    (lambda d, keep: langid.identify(d, langid.fit(d.withColumn("lang", F.lit("en"))), keep=keep), "score"),
    (lambda d, keep: quality.quality_rules(d, keep=keep, with_text=True), "n_words"),
    (lambda d, keep: packing.pack_documents(d, tokenizer_file("word_bpe_49k.json"), keep=keep), "length"),
    (lambda d, keep: bpe.round_trip(d, tokenizer_file("byte_bpe_50k.tiktoken"), pretoken_pattern(), keep=keep), "n_tokens"),
    (lambda d, keep: url_filter.filter_urls(d, keep=keep, url="text"), "Host"),
    (lambda d, keep: html.extract_text(d, keep=keep, url="text", html="text"), "n_chars"),
    (lambda d, keep: pii.find_pii(d, keep=keep), "spans"),
]


@pytest.mark.parametrize("run,name", CLASHING)
def test_kept_columns_named_like_results(spark, run, name):
    docs = spark.createDataFrame([(1, "some words here", "a", "b"), (2, None, None, "c")], f"doc_id long, text string, `{name}` string, `{name}_kept` string")
    docs = docs.withColumn("source", F.lit("s"))
    out = run(docs, ("doc_id", name))
    assert sum(c.lower() == name.lower() for c in out.columns) == 1 and f"{name}_kept_kept" in out.columns
    assert {(r["doc_id"], r[f"{name}_kept_kept"]) for r in out.collect()} == {(1, "a"), (2, None)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 7), min_size=1, max_size=6), st.integers(0, 10_000))
def test_viterbi_is_optimal(sizes, seed):
    from itertools import product

    rng = np.random.default_rng(seed)
    first = np.cumsum([0, *sizes])
    scores = rng.integers(-8, 1, (first[-1], 3)).astype(float)
    label = langid.viterbi(scores, first, 2.0)
    value = lambda s, p: sum(s[i, x] for i, x in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:]))
    for a, b in zip(first[:-1], first[1:]):
        if a < b:
            s = scores[a:b]
            assert value(s, label[a:b].tolist()) == max(value(s, p) for p in product(range(3), repeat=int(b - a)))


def test_held_out_language_accuracy(spark):
    from marquee.llm.queries import QUERIES

    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right, n = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.98


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=1), st.integers(2, 9))
def test_repeated_words(texts, window):
    for w in [[x.encode() for x in t] for t in texts]:
        grams = Counter(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
        cover = {j for i in range(len(w) - window + 1) if grams[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        assert quality.repeated_words(w, window) == len(cover)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (7, 7), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("run", [
    lambda d: jaccard.similar_groups(d), lambda d: suffix.suffix_dedup(d), lambda d: line_dedup.drop_repeated_lines(d), lambda d: quality.quality_rules(d),
    lambda d: packing.pack_documents(d, tokenizer_file("word_bpe_49k.json")), lambda d: bpe.round_trip(d, tokenizer_file("byte_bpe_50k.tiktoken"), pretoken_pattern()),
    lambda d: langid.identify(d, langid.fit(d)), lambda d: suffix.without_repeats(d)])
def test_empty_table_and_null_rows(spark, run):
    assert run(frame(spark, [])).count() == 0
    assert run(frame(spark, [(None, None), (None, None), (1, None)])).count() == 3


def test_short_merges_equal_the_heaps(monkeypatch):
    """Looking through all neighbours gives the heap's ids; a worker's tasks share one codec."""
    from types import SimpleNamespace

    rng = random.Random(5)
    ranks = {bytes([b]): b for b in range(97, 101)}
    while len(ranks) < 60:
        ranks.setdefault(b"".join(rng.choices(list(ranks), k=2)), 200 + len(ranks))
    tokens = [bytes(rng.choices(range(97, 101), k=rng.randrange(1, bpe.SHORT + 1))) for _ in range(500)]
    short = [bpe.merge_short(t, ranks) for t in tokens]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [bpe.merge_bytes(t, ranks) for t in tokens]
    shared = SimpleNamespace(value=(ranks, bpe.PerfectHash(list(ranks), list(ranks.values()))))
    assert bpe.worker_codec("one", shared, r"\S+") is bpe.worker_codec("one", shared, r"\S+")
    assert bpe.worker_codec("two", shared, r"\S+") is not bpe.worker_codec("one", shared, r"\S+")
