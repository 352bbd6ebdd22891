"""Operators on pages and vectors against brute force, with awkward rows."""

import re
from fnmatch import translate

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from marquee.llm import embedding, html, url_filter

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="cookie-notice">Accept all</div><div class="ad">Buy <p>now</p></div><article class="post-{k}"><h2>Title &amp; {k}</h2><p>First <b>bold</b>
 para&shy;graph<span class="ad">!!</span> of page {k}.<br>More</p><p class="promo">promoted</p><script>if (a < b) {{ "</p>" }}</script><p>Last &#233;&lt;</p>
<form>Search <input></form><section id="comments"><p>Reader says {k}</p></section></article><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_extraction(spark):
    rows = [(k, "http://Host.example.org/a" if k % 2 else "http://host.example.org/b", PAGE.format(k=k)) for k in range(6)]
    rows += [(10, "http://other.example/", "<div><p>only words here</p></div><div class=footer>foot</div>"), (11, None, "plain &amp; text"), (12, "http://h/", None), (13, "x", ""),
             (14, "http://host.example.org/c", "<body><p>no article"), (0, "http://host.example.org/b", PAGE.format(k=0)), (15, "http://z/", "<article><p>cut &am"), (16, "http://z/", "<article><p>cut <a hre"),
             (17, "http://long/", "<article>" + "<p>" + "word " * 50000 + "</article>")]
    got = {(r["page_id"]): r for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k]["text"] == f"Title & {k}\n\nFirst bold para­graph of page {k}. More\n\nLast é<"
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert [got[k]["text"] for k in (10, 11, 12, 13, 14, 15, 16)] == ["only words here", "plain & text", "", "", "no article", "cut &am", "cut"]
    assert got[17]["n_chars"] == 50000 * 5 - 1
    assert html.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_host_vote_decides(spark):
    # most pages of the host have their text in div.story; one page has more text elsewhere
    page = lambda a, b: f"<body><div class=story><p>{a}</p></div><div class=x><p>{b}</p></div></body>"
    rows = [(k, "http://h/", page("story words " * 20, "x")) for k in range(5)] + [(9, "http://h/", page("short story", "much longer other text " * 20))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [tuple(r) for r in html.winning_paths(html.host_votes(df)).collect()] == [("h", ">body>div.story")]
    got = {r["page_id"]: r["text"] for r in html.extract_text(df).collect()}
    assert got[9] == " ".join(["much longer other text"] * 20) and got[0] == " ".join(["story words"] * 20)     # page 9's article stands elsewhere


LONG = "A paragraph of the article that is long enough to count."


def test_parts_of_an_article_stay(spark):
    """Text beside the largest container, headers and boxes inside an article; comments of readers go."""
    three = f"<body><div class=menu>x</div><div class=lead><p>Lead. {LONG}</p></div><div class=body>{f'<p>{LONG}</p>' * 30}</div><div class=after><p>End. {LONG}</p></div></body>"
    head = f"<body><header>Site</header><article><header><h1>Title</h1></header><div class=section-header>Part</div><p>{LONG}</p><div class=alert>Mind this</div><div class=widget>Box</div><footer>by</footer></article></body>"
    talk = f"<body><div class=post><h1>T</h1><p>{LONG}</p></div><div class=reader-comments><p>{LONG * 9}</p></div><div id=user-comments>{LONG * 9}</div></body>"
    rows = [(k, "http://three/", three) for k in range(3)] + [(10, "http://head/", head), (11, "http://talk/", talk)]
    # two templates of a host: each keeps its own container
    rows += [(20 + k, "http://two/", f"<body><div class=main><p>{LONG}</p></div><div class=odd>Footnote {k}</div></body>") for k in range(8)]
    rows += [(30 + k, "http://two/", f"<body><div class=main><p>{LONG}</p></div><div class=more><p>More. {LONG}</p></div></body>") for k in range(4)]
    got = {r["page_id"]: r["text"] for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "\n\n".join([f"Lead. {LONG}", *[LONG] * 30, f"End. {LONG}"])
    assert got[10] == f"Title\n\nPart\n\n{LONG}\n\nMind this\n\nBox"
    assert got[11] == f"T\n\n{LONG}"
    assert got[20] == LONG and got[30] == f"{LONG}\n\nMore. {LONG}"


def test_hot_host_of_many_paths(spark):
    """Every page votes for a path of its own; the host keeps a bounded number of winners."""
    rows = [(k, "http://hot/", f"<body><div class=x{'abcdefgh'[k % 8]}{'z' * (k // 8)}><p>{LONG} {k}</p></div><div class=other>{k}</div></body>") for k in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    ranked = html.ranked_paths(html.host_votes(df)).collect()
    assert len(ranked) == 1 and len(ranked[0]["paths"]) == html.WINNERS
    assert {r["text"] for r in html.extract_text(df).collect()} == {f"{LONG} {k}" for k in range(200)}


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a b='" * 200_000, "<a b=\"" * 200_000, "<p x=\">\" <a " * 90_000, "<!--" * 250_000, "<!" * 500_000, "</script" * 130_000,
                                  "<script>" + "</script " * 120_000, "<script>" * 130_000, "</section>" * 100_000, "<div>" * 20_000 + "</section>" * 80_000, "<" * 1_000_000,
                                  "<div>" * 200_000, "<div class='a b'>" * 60_000 + "text", "<div><p>t" * 100_000, "&" * 1_000_000, "&amp" * 250_000, "<html><body>" * 80_000,
                                  "<span class=ad>" * 60_000, "<div class='" + "box-" * 200_000 + "'>x", "<a href=x>y" * 90_000, "<div " + "a=1 " * 250_000 + ">t"])
def test_broken_megabyte_pages_are_read_in_linear_time(page):
    import time
    import tracemalloc

    for part, limit in ((page[:20_000], None), (page, 4)):
        at = time.perf_counter()
        p = html.Page(part)
        p.text(None), p.best()[0].path()
        assert limit is None or time.perf_counter() - at < limit
    if page.startswith("<div>" * 200_000):
        tracemalloc.start()
        html.Page(page).text(">body")
        assert tracemalloc.get_traced_memory()[1] < 200_000_000
        tracemalloc.stop()


def test_tags_cut_off_or_unquoted():
    read = lambda x: [t for _, t, _ in html.Page(x).blocks]
    assert read("a <b and c > d") == ["a d"] and read("1 < 2 <p>x") == ["1 < 2", "x"] and read("x<p title='a>b' hidden>y") == ["x"]
    assert read("x<p class=it's>y</p>z") == ["x", "y", "z"] and read("x <a href='open>y</a> z <b>w") == ["x y z w"]
    assert read("x<!-- a > b -->y<!bogus>z<?pi?>w</ >v") == ["xyzwv"] and read("x<!-- open <p>y") == ["x"]
    assert read("<SCRIPT>var a='</p>'</Script >t<style>p{}") == ["t"] and read("<p/>x<br/>y<div/>z") == ["x y", "z"]
    assert read("t<p class=a class=ad>x") == ["t", "x"] and read("t<p class=ad class=a>x") == ["t"]


ASIDE_TAGS, ASIDE_CLASSES = ("nav", "aside", "footer", "form"), ("ad", "cookie-notice", "comments", "site-footer")
TEXTS = ["short", "Some words that are long enough to be substantial here", "Another paragraph which is long enough to count as well", "x"]
leaves = st.tuples(st.sampled_from(["p", "h2", "li"]), st.just(None), st.sampled_from(TEXTS))
trees = st.recursive(leaves, lambda kids: st.tuples(st.sampled_from(["div", "section", "article", "main", "ul", "header", *ASIDE_TAGS]),
                                                    st.sampled_from([None, None, "a", "b12", "section-header", "alert", *ASIDE_CLASSES]), st.lists(kids, max_size=4)), max_leaves=25)


def walked(tree, above=()):
    """(elements above and the text) of every block that isn't set aside: a plain walk over the tree."""
    tag, name, inside = tree
    if isinstance(inside, str):
        return [(above, inside)]
    article = any(t[0] == "article" for t in above)
    if tag in ASIDE_TAGS or tag == "header" and not article or name in ASIDE_CLASSES or name == "alert" and not article:
        return []
    return [b for k, kid in enumerate(inside) for b in walked(kid, (*above, (tag, name, id(tree), k)))]


def written_out(tree):
    tag, name, inside = tree
    return f"<{tag}{f' class={name}' if name else ''}>" + (inside if isinstance(inside, str) else "".join(map(written_out, inside))) + f"</{tag}>"


def brute_text(kids):
    body = ("body", None, kids)
    blocks = [(tuple(e[:3] for e in above), t) for above, t in walked(body)]
    some = [b for b in blocks if len(b[1]) >= 25]
    if any(e[0] == "article" for above, _ in some for e in above):
        some = [b for b in some if any(e[0] == "article" for e in b[0])]
    elif mains_of(body) and [b for b in some if any(e[2] == mains_of(body)[0] for e in b[0])]:
        some = [b for b in some if any(e[2] == mains_of(body)[0] for e in b[0])]
    some = some or blocks
    if not some:
        return ""
    common = list(some[0][0])
    for above, _ in some:
        common = [a for a, b in zip(common, above) if a == b]
    while common and common[-1][0] not in ("body", "main", "article", "section", "div"):
        common.pop()
    for k, e in enumerate(common):
        if e[0] == "article":
            common = common[:k + 1]
            break
    return "\n\n".join(t for above, t in blocks if list(above[:len(common)]) == common)


def mains_of(tree):
    """All main elements in page order, set aside or not."""
    if isinstance(tree[2], str):
        return []
    return [id(tree)] * (tree[0] == "main") + [m for kid in tree[2] for m in mains_of(kid)]


@settings(max_examples=400, deadline=None)
@given(st.lists(trees, max_size=4))
def test_page_against_a_plain_walk_of_its_tree(kids):
    # elements are told apart by identity, so each is made anew
    copy = lambda t: [t[0], t[1], t[2] if isinstance(t[2], str) else [copy(k) for k in t[2]]]
    kids = [copy(k) for k in kids]
    source = "<html><body>" + "".join(map(written_out, kids)) + "</body></html>"
    page = html.Page(source)
    if page.names:          # else all text was set aside by name
        assert page.text(None) == brute_text(kids)


def test_pages_without_a_host_do_not_vote(spark):
    rows = [(k, url, f"<body><div class=a><p>{'words ' * 20}</p></div><div class=b><p>x</p></div></body>") for k, url in enumerate((None, "x", "y"))]
    rows += [(9, None, f"<body><div class=a><p>x</p></div><div class=b><p>{'text ' * 20}</p></div></body>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_text(df).collect()}
    assert got[9] == " ".join(["text"] * 20) and all(got[k] == " ".join(["words"] * 20) for k in range(3))


def test_parts_of_names_set_nothing_aside():
    for sign in ("main class='content with-sidebar'", "div class=no-sidebar", "div class=has-header", "div class='page-header-fixed x'", "section id='related-work'", "section id=discussion",
                 "section id=legal-status", "section id='search-algorithms'", "p id=search-algorithms", "h2 id=related-work"):
        tag = sign.split()[0]
        assert html.Page(f"<body><p>before</p><{sign}>of the article</{tag}></body>").text(">body") == "before\n\nof the article", sign
    for sign in ("div class='ad'", "div class=cookie-notice", "div class='x site-footer'", "section id=comments", "div class='sidebar left'", "div class=related-posts", "ul class=share-buttons", "p class=promo", "div class='ad-300x250'"):
        tag = sign.split()[0]
        assert html.Page(f"<body><p>before</p><{sign}>other</{tag}></body>").text(">body") == "before", sign
    assert html.Page("<body><div class=sidebar><p>all of the page</p></div></body>").text(None) == "all of the page"
    assert html.Page("<body><div style='display:none' class=ad>x</div></body>").text(None) == ""


def brute_visits(glob, text):
    pattern = ""
    i = 0
    while i < len(glob):
        if glob.startswith("**", i):
            pattern, i = pattern + ".*", i + 2
        elif glob[i] == "*":
            pattern, i = pattern + "[^/?]*", i + 1
        elif glob[i] == "\\":
            pattern, i = pattern + re.escape(glob[i + 1]), i + 2
        else:
            pattern, i = pattern + ("." if glob[i] == "?" else re.escape(glob[i])), i + 1
    return re.fullmatch(pattern, text, re.S) is not None


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab/*?", max_size=9), max_size=30), st.lists(st.text("ab/?", max_size=14), max_size=8))
def test_automaton_matches_like_regular_expressions(globs, texts):
    got = url_filter.GlobAutomaton(globs).match([t.encode() for t in texts])
    assert got.tolist() == [[brute_visits(g, t) for g in globs] for t in texts]
    assert translate  # the globs here aren't shell globs


def test_url_rules(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/de/x", "http://com/fr/", "http://xcom/fr/", "http://b.com", "http://b.com?x=/fr/",
            "http://evil.net/x.org/", "ftp://n.net/f.EXE", "http://n.net/f.exe", "http://n.net/f.exe#y", "http://n.net/p?sessionid=4", "http://ads.n.net/", None, "", "no scheme", "http://", "http://" + "a" * 5000 + ".org/"]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(df).collect()}
    assert [got[i]["rule"] for i in range(10)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", "com/fr/", None, None, None, None]
    assert [got[i]["verdict"] for i in range(20)] == ["block", "block", "allow", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow", "block", "block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert got[1]["host"] == "example.org" and got[1]["path"] == "/en/12" and got[8]["path"] == "" and got[15]["host"] == "" and got[19]["rule"] == "org/"
    assert url_filter.filter_urls(df.where("false")).count() == 0


def brute_links(rows, limit=0.95):
    x = {i: np.array(v, float) for i, (_, v) in enumerate(rows) if v and len(v) == 16 and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in x.items()}
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in unit:
        for j in unit:
            if i != j and unit[i] @ unit[j] >= limit:
                links[i] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), (1 << 62) if k is None else k)
    return sorted(((1 << 62) if k is None else k, links[i], least[find(i)]) for i, (k, _) in enumerate(rows))


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for g in range(30):
        centre = rng.standard_normal(16)
        rows += [(len(rows) + 1, [float(c) for c in centre + 0.12 * rng.standard_normal(16)]) for _ in range(1 + g)]
    same = rows[5][1]
    return rows + [(1000 + k, same) for k in range(20)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, [float("inf")] + [1.0] * 15),
                                                        (2005, [1.0, 2.0]), (2006, []), (None, same), (1, rows[0][1]), (2007, [1e-30 * c for c in same]), (2008, [1e30 * c for c in same])]


def test_near_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in rows], "vec_id long, embedding array<float>, c string, id string")
    exact = [(k, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for k, v in rows]
    got = embedding.near_vectors(df).collect()
    real = lambda x: (1 << 62) if x is None else x
    found, true = sorted((real(g["id"]), g["n_links"], real(g["component_id"])) for g in got), brute_links(exact)
    assert [f[0] for f in found] == [t[0] for t in true]
    assert all(f[1] <= t[1] for f, t in zip(found, true))
    assert sum(f[1] for f in found) >= 0.9 * sum(t[1] for t in true)
    assert all(g["kept"] == (g["id"] == g["component_id"]) for g in got if g["id"] is not None)
    assert embedding.near_vectors(df.where("false")).count() == 0
    assert [r["n_links"] for r in embedding.near_vectors(df.where("embedding is null")).collect()] == [0]


def linked_vectors(rng, n, dims, centres):
    """Vectors in loose clusters, a third of them with a partner at a cosine of 0.95 to 0.97."""
    x = rng.standard_normal((centres, dims))[rng.integers(0, centres, n)] + 1.2 * rng.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base = x[:n // 3]
    away = rng.standard_normal(base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cos = rng.uniform(0.9505, 0.97, (len(base), 1))
    return np.concatenate([x, cos * base + np.sqrt(1 - cos * cos) * away])


@pytest.mark.parametrize("dims,centres", [(64, 1), (64, 40), (16, 300)])
def test_recall_of_links_near_the_limit(spark, tmp_path, dims, centres):
    """Links that are hardest to find, as many words as the codebooks of so many vectors have."""
    x = linked_vectors(np.random.default_rng(11), 6000, dims, centres)
    path = str(tmp_path / "vectors")
    pd.DataFrame({"vec_id": range(len(x)), "embedding": [v.tolist() for v in x]}).to_parquet(path)
    df = spark.read.parquet(path).repartition(8)
    unit = embedding.unit(x)
    true = int((unit @ unit.T >= 0.95).sum()) - len(x)
    found = sum(r["n_links"] for r in embedding.near_vectors(df).collect())
    print(f"recall {found / true:.4f} of {true} links, {dims} parts, {centres} clusters")
    assert true >= 4000 and 0.9 * true <= found <= true


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 5)
    rows = [(k, v) for k, v in vectors() if k is not None and k < 1000]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((g["id"], g["n_links"], g["component_id"]) for g in embedding.near_vectors(df, recall=0.9999).collect()) == brute_links(rows)


def test_every_length_is_compared_within_itself(spark):
    rng = np.random.default_rng(5)
    rows = []
    for d, groups in ((16, 30), (24, 20), (1, 3), (2, 4)):
        for g in range(groups):
            centre = rng.standard_normal(d)
            rows += [(len(rows) + k, [float(c) for c in centre + 0.12 * rng.standard_normal(d)], d) for k in range(1 + g)]
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, len(rows), 9)]
    df = spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<double>")
    found = {g["id"]: (g["n_links"], g["component_id"]) for g in embedding.near_vectors(df, recall=0.9999).collect()}
    for d in (16, 24, 1, 2):
        unit = {i: np.array(v) / np.linalg.norm(v) for i, v, size in rows if size == d}
        true = {i: sum(i != j and float(unit[i] @ unit[j]) >= 0.95 for j in unit) for i in unit}
        assert {i: found[i][0] for i in unit} == true
        assert all(found[i][1] in unit for i in unit)
