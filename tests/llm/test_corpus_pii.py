"""Personal data: the plain patterns as stated, disguises by a character-wise reader."""

import re
import time
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

from marquee.llm import pii

KINDS = ("email", "ip", "card", "phone")
# the patterns as the contract states them; checks below
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_of(text):
    return [(k, *m.span()) for k, name in enumerate(KINDS) for m in re.finditer(PATTERNS[name], text) if valid(name, m[0])]


pieces = st.sampled_from(["a", "Z", "9", "4", "0", ".", "-", "+", "@", " ", "(", ")", "é", "\n", "_", "john", "example", ".com", "192.168.0.1", "256",
                          "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "a@b.c", "00000", "1.2.3.4.5"])


@settings(max_examples=600, deadline=None)
@given(st.lists(pieces, max_size=25).map("".join))
def test_base_spans_are_the_patterns(text):
    assert pii.spans_of(text) == base_of(text)


# (disguised, plain) parts; the reader below joins them character by character
DISGUISED = [
    ("john (at) example [dot] com", "email", "john (at) example [dot] com"),
    ("john at example dot com", "email", "john at example dot com"),
    ("write to mary.b [at] mail.example.org, or", "email", "mary.b [at] mail.example.org"),
    ("x: j{dot}doe@site.net!", "email", "j{dot}doe@site.net"),
    ("jоhn@ехample.com", "email", "jоhn@ехample.com"),
    ("john​@exam­ple.com", "email", "john​@exam­ple.com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("10[.]0[.]0[.]1", "ip", "10[.]0[.]0[.]1"),
    ("host one nine two dot 168 dot one dot seven", "ip", "one nine two dot 168 dot one dot seven"),
    ("١٩٢.١٦٨.٠.١", "ip", "١٩٢.١٦٨.٠.١"),
    ("card four one one one 1111 1111 one one one one now", "card", "four one one one 1111 1111 one one one one"),
    ("4111‑1111‑1111‑1111", "card", "4111‑1111‑1111‑1111"),
    ("call plus four nine 30 1234567 today", "phone", "plus four nine 30 1234567"),
    ("+1 2O2 555 l234", "phone", None),
    ("ask john_at_example_dot_com for it", "email", "john_at_example_dot_com"),
    ("ask johnATexampleDOTcom for it", "email", "johnATexampleDOTcom"),
    ("mail john @ example.com now", "email", "john @ example.com"),
    ("mail john.b @ mail . example . com now", "email", "john.b @ mail . example . com"),
    ("john&#64;example&#46;com", "email", "john&#64;example&#46;com"),
    ("x john%40example.com", "email", "john%40example.com"),
    ("plus one, five, five, five, oh one double two three four five", "phone", "plus one, five, five, five, oh one double two three four five"),
    ("plus vier neun drei null eins zwei drei vier fünf sechs", "phone", "plus vier neun drei null eins zwei drei vier fünf sechs"),
    ("plus trois trois un deux trois quatre cinq six sept huit", "phone", "plus trois trois un deux trois quatre cinq six sept huit"),
    ("10 . 0 . 0 . 25", "ip", "10 . 0 . 0 . 25"),
    ("+1 2O2 555 0l23", "phone", "+1 2O2 555 0l23"),
    ("＋４９ ３０ １２３４５６７", "phone", "＋４９ ３０ １２３４５６７"),
]
CLEAN = ["look at example.com", "meet me at noon, dot your eyes", "one two three four five", "five plus three is eight", "He sat at home. Dot ran.",
         "at two points dot dot dot", "version 1.2.3 (at) best", "see [1] at 10.30", "the one at one dot one", "oh one day", "double the price", "a polka-dot-dress", "stay-at-home", "CATalogue DOTs", "we met @ noon. Then left", "100%40 and &#65;",
         "sept huit", "un, deux, trois", "STATE of BATtle DOT", "x @ y", "почта в москве", "Ο Νίκος στις 10.30"]


@pytest.mark.parametrize("text,kind,part", DISGUISED)
def test_disguises_are_found_where_they_stand(text, kind, part):
    for before, after in (("", ""), ("Zoë says: ", " – and so on"), ("one two\n", " .")):
        full = before + text + after
        found = [(KINDS[k], full[a:b]) for k, a, b in pii.Transducer.own().added(full, pii.spans_of(full))]
        assert found == ([(kind, part)] if part else [])


@pytest.mark.parametrize("text", CLEAN)
def test_clean_prose_stays(text):
    assert pii.Transducer.own().added(text, pii.spans_of(text)) == []


tokens = st.sampled_from(["_at_", "_dot_", "AT", "DOT", " @ ", " . ", "&#64;", "%2E", "oh ", "double ", "deux ", "zwei, ", "john", "x1", " (at) ", "[dot]", " dot ", " at ", "com", "one", " ", "-", "five", "plus ", "＋", "é", "о", "​", "1O1", "@", ".", "4111 1111", "７", "\n", "(", " "])


@settings(max_examples=400, deadline=None)
@given(st.lists(tokens, max_size=30).map("".join))
def test_stretches_cover_the_source(text):
    """Every code point is read by one stretch, in order; what no token stands
    for is the look-alike of what stands there."""
    undo = pii.Transducer.own()
    plain, parts = undo.normal(text)
    at = 0
    for k, (made, start, length, token) in enumerate(parts):
        assert start == at and made == (parts[k - 1][0] if k and parts[k - 1][0] == made else made)
        at += length
        if not token:
            assert plain[made:made + length] == text[start:start + length].translate(undo.chars)
    assert at == len(text)
    base = pii.spans_of(text)
    for kind, a, b in undo.added(text, base):
        assert 0 <= a < b <= len(text) and not any(k == kind and s <= a and b <= e for k, s, e in base)
        again = undo.normal(text[a:b])[0].strip(" -")
        assert any(k == kind for k, _, _ in pii.spans_of(again)), (text[a:b], again)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "+1" + " " * 300_000, "@" * 300_000, "a@" * 150_000,
                                  "a@" + "b" * 300_000, "a@" + "b." * 150_000, "( " * 150_000, "(" + " " * 300_000 + "at", "a @ " * 75_000, "a @ b.c " * 40_000, "a" + " " * 150_000 + "@ b.c" + " " * 150_000 + "@ b.c", " . " * 100_000, "a_at_" * 60_000, "aAT" * 100_000, "aATbDOT" * 40_000, "double " * 50_000, "oh " * 100_000, "&#64;" * 60_000, "a @" + " " * 300_000, " at a" * 60_000,
                                  " at " + "a" * 300_000, "x dot " * 50_000, "one " * 75_000, " " * 300_000, "1O" * 150_000, "1.1.1.1 1[.]1[.]1[.]1 " * 15_000, "a at b" + " " * 300_000 + "c", "​" * 300_000])
def test_long_texts_take_linear_time(text):
    at = time.perf_counter()
    base = pii.spans_of(text)
    pii.Transducer.own().added(text, base)
    assert time.perf_counter() - at < 3


def test_query_form(spark):
    texts = [None, "", "mail a@b.co and +1 555 123 4567", "b (at) c (dot) org, a@b.co", "plain text", "plain text"]
    docs = spark.createDataFrame([(i if i != 1 else None, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, other string")
    rows = pii.find_pii(docs, keep=("doc_id", "other"), with_text=True).orderBy("doc_id").collect()
    by_text = dict(zip([t for i, t in sorted(((-1 if i == 1 else i), t) for i, t in enumerate(texts))], rows))
    for t, r in by_text.items():
        base = base_of(t or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert r["base_sha256"] == sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert by_text["b (at) c (dot) org, a@b.co"]["spans"] == "email:0:18,email:20:26"
    assert by_text["b (at) c (dot) org, a@b.co"]["redacted"] == "<email>, <email>"
    assert by_text[None]["redacted"] is None and by_text[None]["spans"] == ""
    assert pii.find_pii(docs.where("false")).collect() == []
    clash = pii.find_pii(docs.withColumnRenamed("other", "Spans"), keep=("doc_id", "Spans"))
    assert clash.columns[:2] == ["doc_id", "Spans_kept"] and {r["Spans_kept"] for r in clash.collect()} == {"k"}
