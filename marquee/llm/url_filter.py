"""URL rules and glob lists, simulated together by one bit-parallel automaton.

Every glob is a row of states; all globs' states lie side by side in a vector
of 64-bit words. One step of the automaton reads one byte of every URL of a
batch: shift the state words by one (with the carry from word to word), keep
what the byte lets through, and keep the looping states of wildcards. So the
cost of a byte does not depend on how many globs are alive in it, only on the
number of words.

Glob syntax: ``**`` any bytes, ``*`` any bytes but ``/`` and ``?``, ``?`` must
be written ``\\?`` when meant as itself, a plain ``?`` is one byte.

Nulls: a null URL, or one without ``://``, has an empty host and path; no rule
fits it and the glob list sees an empty string. Very long URLs run to their
end. Repeated rows give repeated results; an empty table gives none. Further
columns of the input are left out unless named in ``keep``; a kept one named
like a result gets ``_kept`` after its name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.common import prepare, without_clash

#: Rules by host and path: (verdict, rule).
HOST_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
              ("allow", "com/fr/"), ("block", "com/de/"))
#: Globs for URLs without a rule: a match blocks. Canonical URL: host, path, query.
BLOCK_GLOBS = ("**.exe", "**.zip", "**.jpg", "**.png", "**.css", "**.js", "**/login**", "**/cart**",
               "**/wp-admin/**", "**/cgi-bin/**", "ads.**", "*.ads.**", "**\\?**sessionid=**")
ANY = np.ones(256, bool)
IN_SEGMENT = np.ones(256, bool)
IN_SEGMENT[[ord("/"), ord("?")]] = False


def parse_glob(glob: str) -> tuple[list[np.ndarray], dict[int, np.ndarray]]:
    """The bytes that each step accepts, and the bytes on which a state stays."""
    steps: list[np.ndarray] = []
    loops: dict[int, np.ndarray] = {}
    raw, i = glob.encode(), 0
    while i < len(raw):
        c = raw[i:i + 1]
        if c == b"*":
            wide = raw[i:i + 2] == b"**"
            loops[len(steps)] = loops.get(len(steps), ~ANY) | (ANY if wide else IN_SEGMENT)
            i += 1 + wide
            continue
        if c == b"\\":
            i += 1
            c = raw[i:i + 1]
            steps.append(np.arange(256) == c[0])
        else:
            steps.append(ANY if c == b"?" else np.arange(256) == c[0])
        i += 1
    return steps, loops


class GlobAutomaton:
    """All globs in one state vector; anchored at both ends."""

    def __init__(self, globs: Sequence[str]):
        parsed = [parse_glob(g) for g in globs]
        self.first = np.cumsum([0, *(len(s) + 1 for s, _ in parsed)])
        self.words = max(1, -(-int(self.first[-1]) // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.last = [int(self.first[k]) + len(s) for k, (s, _) in enumerate(parsed)]
        for k, (steps, loops) in enumerate(parsed):
            at = int(self.first[k])
            self._set(self.start, at)
            for j, accepts in enumerate(steps):
                self.step[accepts, (at + j + 1) // 64] |= np.uint64(1 << ((at + j + 1) % 64))
            for j, accepts in loops.items():
                self.stay[accepts, (at + j) // 64] |= np.uint64(1 << ((at + j) % 64))

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << (bit % 64))

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean (text, glob)."""
        n = len(texts)
        out = np.zeros((n, len(self.last)), bool)
        if not n or not self.last:
            return out
        size = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-size, kind="stable")
        lengths, offsets = size[order], np.cumsum([0, *size])[:-1][order]
        data = np.frombuffer(b"".join(texts), np.uint8)
        state = np.tile(self.start, (n, 1))
        alive = n
        for i in range(int(lengths[0])):
            while lengths[alive - 1] <= i:
                alive -= 1
            c = data[offsets[:alive] + i]
            d = state[:alive]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:alive] = (moved & self.step[c]) | (d & self.stay[c])
        for k, bit in enumerate(self.last):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        return out


LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path, and the query with its question mark."""
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0]
    rest, mark, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path, mark + query


class UrlJudge:
    def __init__(self, rules: Sequence[tuple[str, str]], block_globs: Sequence[str]):
        self.rules = sorted(rules, key=lambda r: -len(r[1]))  # the longest first
        quote = lambda s: "".join("\\" + c if c in "*?\\" else c for c in s)
        globs = [g for _, r in self.rules for g in (f"{quote(r)}**", f"*.{quote(r)}**")]
        self.n_rules = len(self.rules)
        self.automaton = GlobAutomaton([*globs, *block_globs])

    def __call__(self, urls: Sequence[str | None]) -> tuple[list, list, list, list]:
        parts = [split_url(u) for u in urls]
        hit = self.automaton.match([(h + p + q).encode("utf-8", "surrogatepass") for h, p, q in parts])
        rules = hit[:, :2 * self.n_rules].reshape(len(urls), self.n_rules, 2).any(axis=2)
        blocked = hit[:, 2 * self.n_rules:].any(axis=1)
        found = np.where(rules.any(axis=1), rules.argmax(axis=1) if self.n_rules else 0, -1)
        rule = [self.rules[k][1] if k >= 0 else None for k in found]
        verdict = [self.rules[k][0] if k >= 0 else "block" if b else "allow" for k, b in zip(found, blocked, strict=True)]
        return [p[0] for p in parts], [p[1] for p in parts], rule, verdict


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = HOST_RULES,
                block_globs: Sequence[str] = BLOCK_GLOBS, keep: Sequence[str] = ("page_id",),
                url: str = "url") -> DataFrame:
    """``keep``, host, path, rule (null if none fits), verdict of each page."""
    prepare(pages.sparkSession)
    judge = UrlJudge(rules, block_globs)
    pages, keep = without_clash(pages, keep, ("host", "path", "rule", "verdict"))
    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), "host string, path string, rule string, verdict string"])
    names = [*keep, "host", "path", "rule", "verdict"]

    def run(batches):
        for batch in batches:
            found = judge(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *(pa.array(x, pa.string()) for x in found)], names=names)

    return pages.select(*(pages[k] for k in keep), pages[url]).mapInArrow(run, schema)


#: The same by SQL; the patterns are the glob list's, written by hand as regular expressions.
SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_replace(substr(url, instr(url, '://') + 3), '#.*$', '', 's') ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, rest, regexp_extract(rest, '^[^?]*') AS hp FROM p),
h AS (SELECT page_id, translate(regexp_extract(hp, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(hp, length(regexp_extract(hp, '^[^/]*')) + 1) AS path, substr(rest, length(hp) + 1) AS query FROM q),
r(verdict, rule, rhost, rpath) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
     ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
m AS (SELECT h.page_id, r.verdict, r.rule, row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule) DESC) AS nr
      FROM h JOIN r ON (h.host = r.rhost OR h.host LIKE '%.' || r.rhost) AND starts_with(h.path, r.rpath)),
c AS (SELECT *, host || path || query AS canon FROM h)
SELECT c.page_id, host, path, m.rule, coalesce(m.verdict, CASE WHEN
    regexp_matches(canon, '\.(exe|zip|jpg|png|css|js)$') OR regexp_matches(canon, '/login|/cart|/wp-admin/|/cgi-bin/')
    OR regexp_matches(canon, '^ads\.') OR regexp_matches(canon, '^[^/?]*\.ads\.') OR regexp_matches(canon, '\?.*sessionid=', 's')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN m ON c.page_id = m.page_id AND m.nr = 1
"""
