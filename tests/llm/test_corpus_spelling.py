"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marquee.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_of(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, out = {}, []
    mates = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(mates[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 5 * n:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(mates[w]), words.get(form.get(w))))
    return out


def vocabulary(rng, size, letters, length):
    words = ["".join(rng.choice(letters) for _ in range(rng.choice(length))) for _ in range(size)]
    for w in words[:size // 2]:
        k = rng.randrange(len(w))
        words.append(rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:], w[::-1]]))
    return words


def rows_of(seed, size=300, letters="abcé", length=range(6, 9)):
    rng = random.Random(seed)
    words = vocabulary(rng, size, letters, length)
    chosen = rng.choices(words, weights=[5 ** rng.randrange(6) for _ in words], k=40 * size)
    rows = [(rng.choice([None, i, -i]), " ".join(rng.choice([w, w.upper(), w.title()]) for w in chosen[i::200])) for i in range(200)]
    return rows + [(None, None), (5, ""), (6, "short 12 -- "), rows[0], (7, "x" * 3000 + " " + "y" * 300 + "," + "A" * 3000)] + [(8, "z" * 300)] * 5 + [(9, "z" * 301)] * 30


@pytest.mark.parametrize("cell", [4096, 16])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, cell):
    """One cell a length, and many cells with cuts from a small sample."""
    rows = rows_of(seed)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, word string").repartition(5)
    found = spelling.spelling_variants(docs, cell=cell, sample=64)
    assert found.columns == COLUMNS
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, variants_of(rows)))


def test_chain_and_ties(spark):
    """Forms lead on to a root; equal counts go to the first word."""
    words = {"abcdefgh": 1000, "abcdefg": 150, "abcdefx": 30, "abcdeyx": 5, "zbcdefg": 150, "zbcdefx": 5}
    rows = [(i, w) for w, n in words.items() for i in range(n) if crc32(f"{i}:{w}".encode()) % 199]
    found = {r["word"]: r for r in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = {r[0]: r for r in variants_of(rows)}
    assert {w: tuple(r) for w, r in found.items()} == expected
    assert found["abcdeyx"]["root"] == "abcdefgh" and found["abcdeyx"]["form"] == "abcdefx"


def test_empty(spark):
    for rows in ([], [(1, None), (2, "a b c")]):
        found = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.columns == COLUMNS and found.collect() == []


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    """A word in every document, long texts and slices that end inside none."""
    monkeypatch.setattr(spelling, "SLICE", 10)
    text = "wordword, another-thing Çağla " * 50
    assert [r for part in spelling.runs(text) for r in part] == re.findall("[a-zÀ-ÿ]+", text.replace("W", "w"))
    rows = spark.createDataFrame([(i, "common thing") for i in range(2000)], "doc_id long, text string").repartition(20)
    hot = sum(crc32(f"{i}:common".encode()) % 199 > 0 for i in range(2000))
    assert {r["word"]: r["n"] for r in spelling.word_counts(rows).collect()} == {"common": hot}


words_of_one_length = st.integers(6, 9).flatmap(lambda n: st.lists(st.text("abcdeü", min_size=n, max_size=n), min_size=1, max_size=60, unique=True))


@settings(max_examples=60, deadline=None)
@given(words_of_one_length, words_of_one_length)
def test_cell_search_finds_every_pair(words, queries):
    if abs(len(words[0]) - len(queries[0])) > 1:
        return
    code = spelling.codes(words)
    p = spelling.points(code)
    tree, leaves = spelling.Tree.build(p, 3)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(words)))
    pairs = [(int(i), int(j)) for x, y in spelling.near_pairs(code, p, tree, leaves, spelling.codes(queries), len(queries[0]) - len(words[0])) for i, j in zip(x, y)]
    assert sorted(pairs) == [(i, j) for i, q in enumerate(queries) for j, w in enumerate(words) if near(q, w)]
