"""Main text of web pages, agreed on by the pages of a host.

1. Each page is read into containers (block elements that hold others). Text
   inside menus, headers, footers, sidebars, notices, adverts, forms, comments
   and the like, by element, role or whole class name or id, is set aside; if
   that leaves no text, names and ids count for nothing. A header inside an
   article is the article's, and names that articles use too (WEAK) count only
   outside of one. The article's text is scored by its substantial blocks (of
   some length, less than half of it links; inside the article or main element
   if there is one), and the page votes for the deepest container that holds
   all of them, or the article element around it, by its generalised path
   (element and class names from body on, digits replaced).
2. Spark sums the votes of each host. Paths are ranked by votes, then score,
   then name; the first one and those with at least a tenth of its votes, at
   most WINNERS, are the host's winning paths.
3. Each page is read again. If its own vote is a winning path, it gives the text
   of its containers at that path; else that of the first winning path that
   holds at least half of its substantial text; else that of its own vote.

Reading is linear in the page whatever it holds: a tag's end is looked for
once, and after the first tag that has none (say, for an open quote) tags end
at the next ``>``. A container keeps its parent and its own name only; paths
are spelled out for votes and compared by checksum, then exactly.

Hot hosts: votes are summed before the shuffle, and winners are joined to the
pages by host and a salt, so a host with a third of all pages is spread over
as many tasks as there are salts. A winner is repeated only for the salts that
its host's pages have, so there are never more such rows than pages. The width
of that join follows the bytes of the pages.

Nulls: a null or empty html has an empty text. URLs that are null
or have no host agree on nothing: their pages use their own best containers. Cut-off
or badly nested markup is read as far as it goes; very long pages are read
whole. Ties go to the path that sorts first. Repeated rows get the same text; an
empty table gives no rows; columns other than ``keep`` and the URL are left out,
and a kept one named like a result gets ``_kept`` after its name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import per_batch, prepare, without_clash, written

#: Characters of a substantial block; winning paths of a host; bytes of pages that a task of the second reading gets.
SUBSTANTIAL, WINNERS, TASK_BYTES = 25, 8, 128 * 1024 ** 2
#: Elements by their role in HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "math", "object", "canvas", "audio", "video", "title", "xmp")
ASIDE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "label", "head"))
CONTAINERS = frozenset(("html", "head", "body", "main", "article", "section", "div", "td", "table", "tbody", "tr", "center", "blockquote", "figure", "ul", "ol", "dl",
                        "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "label"))
BLOCKS = CONTAINERS | frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "hr", "address", "caption", "figcaption", "th", "thead", "tfoot", "option", "summary", "details"))
VOTABLE = frozenset(("body", "main", "article", "section", "div", "td", "center", "blockquote"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "note"))
#: Words of what is not the article. A class or id says so if all of its parts are such words, places or
#: kinds of boxes; parts of longer names (with-sidebar, related-work, page-header-fixed) say nothing.
SIGNS = (r"(?:ads?|adverts?|adsbygoogle|taboola|outbrain|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promoted|nav|navbar|topnav|sidenav|subnav|topbar|navigation|menus?|breadcrumbs?|side-?bars?|footers?|headers?|masthead|"
         r"cookies?|cookiebar|consent|gdpr|notices?|alerts?|pop-?ups?|modals?|overlays?|newsletters?|subscribe|subscriptions?|signup|login|comments?|commentlist|disqus|replies|respond|responses?|discussion|reactions?|related|recommended|recommendations?|"
         r"share|sharing|social|widgets?|toolbars?|pagination|pager|search|legal|copyright|disclaimer|tags?-?list|skip-?link|hidden|teasers?)")
BOXES = r"(?:readers?|users?|visitors?|guests?|site|page|global|top|bottom|left|right|primary|secondary|box|bar|container|wrapper|wrap|block|area|section|links?|list|items?|buttons?|icons?|form|unit|slot|posts?|articles?|stories|thread|\d+(?:x\d+)?)"
NOT_ARTICLE = re.compile(rf"(?:{BOXES}[_-]+)*{SIGNS}(?:[_-]+(?:{SIGNS}|{BOXES}))*", re.I)
#: Words that are ids of headings and sections of articles, too.
SECTION_IDS = re.compile(r"(?:discussion|responses?|reactions?|related|recommended|recommendations?|search|legal|copyright|disclaimer|notices?|alerts?|sharing|social|navigation|consent|advertising|advertisements?|banners?|subscriptions?|cookies?|headers?|footers?|menus?|widgets?|replies)(?:[_-]\d+)?", re.I)
#: Names of boxes inside articles, too.
WEAK = re.compile(rf"(?:{BOXES}[_-]+)*(?:headers?|alerts?|widgets?|search|legal|copyright|disclaimer|discussion|responses?|respond|reactions?)(?:[_-]+{BOXES})*", re.I)
CONTENT_HEADER = re.compile(r"(?:section|articles?|posts?|story|stories|entry|block|list|item|box|unit|thread)[_-]+headers?", re.I)
# parts of a tag, each taken whole
NAME, SPACE, KEY, BARE = (re.compile(x) for x in (r"[^\s/>]++", r"[\s/]*+", r"=?+[^\s/>=]*+", r"[^\s>]*+"))
BLANK = re.compile(r"\s*+")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
DIGITS = re.compile(r"\d+")


def tags(source: str) -> Iterator[tuple[str, bool, str, dict[str, str]]]:
    """(text before it, whether it closes, name, attributes) of each tag, and
    at last the text behind them with an empty name. Comments, declarations
    and the contents of RAW elements are passed over."""
    at = begin = 0
    size, loose, last = len(source), False, source.rfind(">")
    find = lambda i: source.find(">", i) if i <= last else -1
    while (lt := source.find("<", at)) >= 0:
        c = source[lt + 1:lt + 2]
        closing = c == "/"
        if c == "!" or c == "?" or closing and not source[lt + 2:lt + 3].isalpha():
            comment = source.startswith("<!--", lt)
            end = source.find("-->", lt + 2) if comment else find(lt)
            yield source[begin:lt], False, "", {}
            at = begin = size if end < 0 else end + (3 if comment else 1)
            continue
        if not (c.isascii() and c.isalpha() or closing):
            at = lt + 1                         # a plain character
            continue
        m = NAME.match(source, lt + 1 + closing)
        name = m[0].lower()
        end, attributes = find(m.end()), {}
        if end >= 0 and not closing:
            if not loose:
                stop, attributes = _attributes(source, m.end())
                loose = stop < 0                # once: from here on a tag ends at the next '>'
                end = end if loose else stop
            if loose:
                attributes = _attributes(source[m.end():end] + ">", 0)[1]
        if end < 0:                             # cut off: up to what could be the next tag
            end = source.find("<", lt + 1) - 1
            end = size if end < 0 else end
            name = ""
        yield source[begin:lt], closing, name, attributes
        at = begin = end + 1
        if not closing and name in RAW_END:
            stop = RAW_END[name].search(source, at)
            stop = find(stop.start()) if stop else -1
            at = begin = size if stop < 0 else stop + 1
    yield source[begin:], False, "", {}


def _attributes(source: str, at: int) -> tuple[int, dict[str, str]]:
    """Place of the tag's ``>`` (-1: none) and its attributes, the first of each name."""
    found: dict[str, str] = {}
    size = len(source)
    while True:
        at = SPACE.match(source, at).end()
        if at >= size:
            return -1, found
        if source[at] == ">":
            return at, found
        m = KEY.match(source, at)
        at = BLANK.match(source, m.end()).end()
        value = ""
        if source[at:at + 1] == "=":
            at = BLANK.match(source, at + 1).end()
            quote = source[at:at + 1]
            if quote in ('"', "'") and quote:
                stop = source.find(quote, at + 1)
                if stop < 0:
                    return -1, found
                value, at = source[at + 1:stop], stop + 1
            else:
                bare = BARE.match(source, at)
                value, at = bare[0], bare.end()
        found.setdefault(m[0].lower(), value)


class Container:
    __slots__ = ("tag", "label", "parent", "aside", "article", "number", "last", "check", "length")

    def __init__(self, tag: str, label: str, parent: Container | None, aside: bool, number: int):
        self.tag, self.label, self.parent, self.aside, self.number = tag, label, parent, aside, number
        self.last = number                      # the last container inside this one
        self.article = tag == "article" or parent is not None and parent.article
        # of the whole path: its checksum and length
        self.check = crc32(label.encode("utf-8", "surrogatepass"), parent.check) if parent is not None else 0
        self.length = len(label) + (parent.length if parent is not None else 0)

    def path(self) -> str:
        labels, box = [], self
        while box is not None:
            labels.append(box.label)
            box = box.parent
        return "".join(reversed(labels))


class Page:
    """Blocks of text in page order, each with its container."""

    def __init__(self, source: str | None, names: bool = True):
        self.names, self.named = names, False
        self.root = Container("html", "", None, False, 0)
        self.all = [self.root]
        self.blocks: list[tuple[Container, str, int]] = []      # container, text, characters of links
        self._piece: list[str] = []
        self._link = 0
        self._skip = False
        if source:
            self._read(source)
            if self.named and not self.blocks:  # no text is left: then class names and ids mean the layout
                self.__init__(source, False)

    def _aside(self, words: dict[str, str], article: bool) -> bool:
        if not words or not _set_aside(words, self.names, article):
            return False
        self.named = self.named or self.names and not _set_aside(words, False, article)
        return True

    def _flush(self, here: Container) -> None:
        if not self._piece:
            return
        text = " ".join(entities.unescape("".join(self._piece)).split())
        if text and not here.aside and not self._skip:
            self.blocks.append((here, text, min(self._link, len(text))))
        self._piece.clear()
        self._link = 0

    def _read(self, source: str) -> None:
        stack, opened, in_link = [self.root], Counter(), False
        mute = 0  # open spans since one that is set aside
        for text, closing, tag, words in tags(source):
            if text and not mute:
                self._piece.append(text)
                if in_link:
                    self._link += len(text)
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                self._piece.append(" ")
            elif tag == "span":
                mute = max(0, mute - 1) if closing else mute + 1 if mute or self._aside(words, stack[-1].article) else 0
            elif tag in BLOCKS:
                self._flush(stack[-1])
                in_link = self._skip = False
                mute = 0
                top = stack[-1]
                if tag not in CONTAINERS:
                    self._skip = not closing and self._aside(words, top.article)
                elif closing:
                    if opened[tag]:             # else nothing to close; what is closed here was opened once
                        while True:
                            box = stack.pop()
                            box.last = len(self.all) - 1
                            opened[box.tag] -= 1
                            if box.tag == tag:
                                break
                elif not (tag in ("html", "body") and opened[tag]):
                    aside = tag in ASIDE and not (tag == "header" and top.article) or tag not in ("html", "body") and self._aside(words, top.article)
                    kind = "." + ".".join(sorted(set(DIGITS.sub("0", words["class"]).split()))) if words.get("class", "").strip() else ""
                    box = Container(tag, f">{tag}{kind}", top, top.aside or aside, len(self.all))
                    stack.append(box)
                    opened[tag] += 1
                    self.all.append(box)
        self._flush(stack[-1])
        for box in stack:
            box.last = len(self.all) - 1

    def _substantial(self) -> list[tuple[Container, int]]:
        """Containers and score of the blocks that make the article."""
        few = [(c, len(t) - links) for c, t, links in self.blocks if len(t) >= SUBSTANTIAL and 2 * links < len(t)]
        if any(c.article for c, _ in few):
            return [(c, n) for c, n in few if c.article]
        mains = [(b.number, b.last) for b in self.all if b.tag == "main"]
        inside = [(c, n) for c, n in few if any(a <= c.number <= b for a, b in mains[:1])]
        return inside or few or [(c, len(t) - links) for c, t, links in self.blocks if len(t) > links] or [(c, len(t)) for c, t, _ in self.blocks]

    def best(self) -> tuple[Container, float]:
        """The container that the page votes for, and its score."""
        found = self._substantial()
        if not found:
            return self.root, 0.0
        last = max(c.number for c, _ in found)
        box = min((c for c, _ in found), key=lambda c: c.number)
        while box.last < last or box.tag not in VOTABLE and box.parent is not None:
            box = box.parent
        up = box
        while up is not None:
            if up.tag == "article":
                box = up
            up = up.parent
        return box, float(sum(n for _, n in found))

    def _at(self, path: str) -> list[Container]:
        check, length = crc32(path.encode("utf-8", "surrogatepass")), len(path)
        return [c for c in self.all if c.check == check and c.length == length and not c.aside and c.path() == path]

    def text(self, paths: str | Sequence[str] | None) -> str:
        """Blocks under the containers at one of the winning paths, or under the page's own vote."""
        own, _ = self.best()
        paths = [paths] if isinstance(paths, str) else list(paths or ())
        chosen = [own]
        if paths:
            mine = own.path()
            if mine in paths:
                chosen = self._at(mine)
            else:
                found = self._substantial()
                total = sum(n for _, n in found)
                for p in paths:
                    boxes = self._at(p)
                    inside = self._inside(boxes)
                    if boxes and 2 * sum(n for c, n in found if inside[c.number]) >= total:
                        chosen = boxes
                        break
        inside = self._inside(chosen)
        return "\n\n".join(t for c, t, _ in self.blocks if inside[c.number])

    def _inside(self, boxes: Sequence[Container]) -> bytearray:
        """Of each container: is it one of the boxes or inside of one?"""
        out = bytearray(len(self.all))
        for box in boxes:
            if not out[box.number]:
                out[box.number:box.last + 1] = b"\1" * (box.last + 1 - box.number)
        return out


def _set_aside(words: dict[str, str], names: bool = True, article: bool = False) -> bool:
    """Do role, class, id or visibility say that an element isn't the article?"""
    return bool(words.get("role", "").lower() in ROLES or words.get("aria-hidden") == "true" or "hidden" in words
                or "display:none" in words.get("style", "").replace(" ", "") or names and _named(words, article))


def _named(words: dict[str, str], article: bool) -> bool:
    def sign(name: str) -> bool:
        return bool(NOT_ARTICLE.fullmatch(name) and not CONTENT_HEADER.fullmatch(name) and not (article and WEAK.fullmatch(name)))

    own = words.get("id", "").strip()
    return any(map(sign, words.get("class", "").split())) or " " not in own and not SECTION_IDS.fullmatch(own) and sign(own)


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[^:]*://([^/?#]*)", 1)), F.lit(""))


def _salt(pages: DataFrame, url: str, html: str):
    """Of a page: one of as many as the shuffle has tasks."""
    return F.pmod(F.xxhash64(pages[url], pages[html]), F.lit(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))).cast("int")


def host_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, salt, path, n, score, bytes): the votes of each host's pages."""
    prepare(pages.sparkSession)

    def vote(batch: pa.RecordBatch):
        texts = batch.column(2).to_pylist()
        found = [Page(h).best() for h in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b.path() for b, _ in found]), pa.array([s for _, s in found], pa.float64()),
                                          pa.array([len(h or "") for h in texts], pa.int64())], names=["host", "salt", "path", "score", "bytes"])

    votes = per_batch(pages.select(host_of(url).alias("host"), _salt(pages, url, html).alias("salt"), pages[html].alias("html")), vote,
                      "host string, salt int, path string, score double, bytes long")
    return written(votes.groupBy("host", "salt", "path").agg(F.count_if(F.col("score") > 0).alias("n"), F.sum("score").alias("score"), F.sum("bytes").alias("bytes")))


def _counted(votes: DataFrame) -> DataFrame:
    return votes.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("score").alias("score")).where("n > 0 and host <> ''")


def winning_paths(votes: DataFrame) -> DataFrame:
    """(host, path): the path with most votes, then the one with the higher score, then the one that sorts first."""
    counted = _counted(votes)
    top = counted.groupBy("host").agg(F.max(F.struct("n", "score")).alias("top"))
    return counted.join(top, "host").where(F.struct("n", "score") == F.col("top")).groupBy("host").agg(F.min("path").alias("path"))


def ranked_paths(votes: DataFrame, most: int = WINNERS) -> DataFrame:
    """(host, paths): the host's winning paths from the first on. A host of any
    number of paths is ranked in parts first, so no task sorts all of them."""
    counted = _counted(votes)
    top = counted.groupBy("host").agg(F.max("n").alias("top"))
    some = counted.join(top, "host").where(F.col("n") * 10 >= F.col("top")).withColumn("part", F.pmod(F.xxhash64("path"), F.lit(64)))
    order = [F.col("n").desc(), F.col("score").desc(), F.col("path").asc()]
    for by in (("host", "part"), ("host",)):
        some = some.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= most)
    first = F.array_sort(F.collect_list(F.struct("place", "path")))
    return some.groupBy("host").agg(F.transform(first, lambda x: x["path"]).alias("paths"))


def extract_text(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), url: str = "url", html: str = "html") -> DataFrame:
    """``keep``, text, n_chars of each page."""
    votes = host_votes(pages, url, html)
    total = votes.agg(F.sum("bytes")).first()[0] or 0
    # not below the session's width, or the join would shuffle the pages once more
    width = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    salted = votes.select("host", "salt").distinct().join(ranked_paths(votes), "host")
    pages, keep = without_clash(pages, keep, ("text", "n_chars"))
    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.select(*(pages[k].alias(f"_k{i}") for i, k in enumerate(keep)), pages[html].alias("html"), host_of(url).alias("host"),
                          _salt(pages, url, html).alias("salt")).repartition(width, "host", "salt")
    joined = source.join(salted, ["host", "salt"], "left").select(*(f"_k{i}" for i in range(len(keep))), "html", "paths")
    n = len(keep)

    def read(batch: pa.RecordBatch):
        texts = [Page(h).text(p) for h, p in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=[*keep, "text", "n_chars"])

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), "text string, n_chars long"])
    return per_batch(joined, read, schema)
