"""Personal data in texts, with disguises undone and offsets kept.

Base spans are what the plain patterns below find in a text as it is. The
method then reads the text through transducers and looks again:

1. one character for one: homoglyphs (full-width and mathematical forms,
   Cyrillic and Greek letters that look Latin, digits of all scripts, odd
   spaces and dashes) become their ASCII look-alikes;
2. tokens for characters: format characters vanish; ``(at)``, ``[dot]``, bare
   `` at `` ... `` dot ``, ``_at_``, ``nameATsiteDOTcom``, `` @ ``, `` . `` and
   character references become ``@`` and ``.``; spelled digits (also ``double``
   ones, in four languages) and ``plus`` become ``0``-``9`` and ``+``; O and l
   between digits become 0 and 1.

The output keeps, for each stretch, where it came from, so what the patterns
find in it maps back to code points of the source. Such a span is added if it
holds something that was disguised, stands on its own (no letter or digit
beside it), ends in a top-level name if it is an address, and no base span of
its kind covers it. Base spans stay as they are.

The patterns are written so that each is linear in the text whatever it holds:
they start from a rare character or where a run starts, and don't give back
what they took. A run whose check fails is dropped whole. Tokens are looked for
by kind (words, brackets, format characters, letters among digits), and a text
without any is its own reading.

Nulls: a null text is an empty one, without spans; null ids pass through.
Repeated rows are judged alike, one by one. Very long texts are read whole.
Ties: spans are ordered by kind, start and end. An empty table gives no rows.
Kept columns pass through; one named like a result gets ``_kept`` after its name.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.common import per_batch, prepare, without_clash

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
LOWER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP_REST = re.compile(r"\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]         # number of the kind, start, end


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def _grown(text: str, rest: re.Pattern, before: frozenset[str]) -> list[tuple[int, int]]:
    """Matches of one or more characters of ``before`` and then ``rest``, which
    starts with a character that is not one of them: found from its rare start."""
    out, end, m = [], 0, rest.search(text)
    while m:
        start = m.start()
        while start > end and text[start - 1] in before:
            start -= 1
        if start < m.start():
            end = m.end()
            out.append((start, end))
        m = rest.search(text, max(m.start() + 1, end))
    return out


def spans_of(text: str) -> list[Span]:
    """What the plain patterns find, by kind and start."""
    out = [(0, a, b) for a, b in _grown(text, DOMAIN, LOCAL)]
    for a, b in _grown(text, IP_REST, DIGITS):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in text[a:b].split("."))):
            out.append((1, a, b))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


# Letters that look like Latin ones, in alphabetical order of their scripts.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝ", "ABESIJKMHOPCTYXaesijopcyxdhqw", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧικνορυ", "ABEZHIKMNOPTYXikvopu", strict=True))
DIGIT_WORDS = {
    "en": ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    "de": ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    "fr": ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    "es": ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
}
TIMES = {"double": 2, "triple": 3}
REFERENCES = {"@": ("&#64;", "&#x40;", "&commat;", "%40"), ".": ("&#46;", "&#x2e;", "&period;", "%2e"), "+": ("&#43;", "&#x2b;", "&plus;", "%2b")}
AT_WORDS, DOT_WORDS = ("at", "arroba"), ("dot", "punto", "punkt", "point")


def _look_alikes() -> dict[int, str]:
    """Code point -> ASCII character, by rule: compatibility forms, decimal
    digits, spaces and dashes of all scripts; then the look-alike letters."""
    out = {}
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        category = unicodedata.category(c)
        if category in ("Cn", "Co", "Cs"):
            continue
        if category == "Nd":
            out[cp] = str(unicodedata.decimal(c))
        elif category == "Zs":
            out[cp] = " "
        elif category == "Pd":
            out[cp] = "-"
        else:
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and "!" <= plain <= "~":
                out[cp] = plain
    # a dotted capital I is an I here, as its lower case is two characters long
    return out | {ord(k): v for k, v in (CYRILLIC | GREEK).items()} | {0x130: "I"}


class Transducer:
    """Both steps over one text; made once a Python worker."""

    _own: Transducer | None = None

    def __init__(self) -> None:
        self.chars = _look_alikes()
        formats = [chr(cp) for cp in range(sys.maxunicode + 1) if unicodedata.category(chr(cp)) == "Cf"]
        self.special = frozenset(map(chr, self.chars)).union(formats)
        one_of = "|".join
        self.digit = {w: str(i) for words in DIGIT_WORDS.values() for i, w in enumerate(words)}
        digit, at, dot = one_of([*self.digit, "oh"]), one_of(AT_WORDS), one_of(DOT_WORDS)
        dot_mark = rf"[\[({{<]\s*+(?:{dot}|\.)\s*+[\])}}>]"
        self.words = re.compile(rf"\b(?:{digit}|{at}|{dot}|{one_of(TIMES)}|plus)\b")
        self.references = re.compile(one_of(re.escape(r) for refs in REFERENCES.values() for r in refs))
        self.meant = {r: c for c, refs in REFERENCES.items() for r in refs}
        self.joined = re.compile(r"[_-](?:(?P<at>at)[_-](?=[a-z0-9]++(?:[_-]dot[_-][a-z0-9]++)+)|dot[_-](?=[a-z0-9]))")
        self.capitals = re.compile(r"(?P<at>AT)(?=[a-z0-9-]++(?:DOT[a-z0-9-]++)+)|DOT(?=[a-z0-9])")
        self.spaced_at = re.compile(rf"@\s++(?=[a-z0-9-]++\s*+(?:\.|{dot_mark}|(?<=\s)(?:{dot})\s))|(?<=\s)@(?=[a-z0-9-]++\.[a-z])")
        self.brackets = re.compile(rf"[\[({{<]\s*+(?:(?P<at>{at}|@)|(?P<dot>{dot}|\.))\s*+[\])}}>]\s*+")
        self.formats = re.compile("[" + "".join(map(re.escape, formats)) + "]+")
        self.letters = re.compile(r"[0-9][ol]+(?=[0-9])")
        # bare words count only where an address is spelled out: " at name dot name"
        self.at_before, self.dot_before = re.compile(r"[a-z0-9_%+-]\s"), re.compile(r"[a-z0-9]\s")
        self.at_after = re.compile(rf"\s++(?=[a-z0-9-]++\s*+(?:{dot_mark}|(?<=\s)(?:{dot})\s+[a-z0-9]))")
        self.dot_after = re.compile(r"\s++(?=[a-z0-9])")
        spelled = rf"(?:{digit}|{one_of(TIMES)})\b"
        self.plus_after = re.compile(rf"[ -]?(?=[0-9]|{spelled})")
        self.digit_after = re.compile(rf"(?:[ -]|, ?)(?={spelled})")
        self.digit_next = re.compile(rf"[ -]({one_of(self.digit)})\b")

    @classmethod
    def own(cls) -> Transducer:
        if cls._own is None:
            cls._own = cls()
        return cls._own

    def _tokens(self, plain: str, special: bool) -> list[tuple[int, int, str]]:
        """(start, end, what it stands for) of tokens in the text."""
        low = plain.lower()
        out = [(m.start(), m.end(), "@" if m["at"] else ".") for m in self.brackets.finditer(low)]
        out += [(m.start(), m.end(), self.meant[m[0]]) for m in self.references.finditer(low)]
        for text, found in ((low, self.joined), (plain, self.capitals)):
            out += [(m.start(), m.end(), "@" if m["at"] else ".") for m in found.finditer(text) if m.start() and text[m.start() - 1] in LOWER]
        if " @" in low or "@ " in low:
            for m in self.spaced_at.finditer(low):
                before = m.start()
                while before and low[before - 1].isspace():
                    before -= 1
                if before and low[before - 1] in LOWER:
                    out.append((m.start(), m.end(), "@"))
        at = low.find(" . ")
        while at >= 0:
            if at and low[at - 1] in LOWER and low[at + 3:at + 4] in LOWER:
                out.append((at, at + 3, "."))
            at = low.find(" . ", at + 2)
        if special:
            out += [(m.start(), m.end(), "") for m in self.formats.finditer(low)]
        for m in self.letters.finditer(low):
            out.append((m.start() + 1, m.end(), "".join("1" if c == "l" else "0" for c in m[0][1:])))
        for m in self.words.finditer(low):
            word, start, end = m[0], m.start(), m.end()
            if word in TIMES:
                if more := self.digit_next.match(low, end):
                    end = more.end()
                    more, new = self.digit_after.match(low, end), TIMES[word] * self.digit[more[1]]
                    out.append((start, more.end() if more else end, new))
            elif word == "oh":                  # a zero only among spelled digits
                more = self.digit_after.match(low, end)
                if more or out and out[-1][1] == start and out[-1][2].isdigit():
                    out.append((start, more.end() if more else end, "0"))
            elif word in self.digit:
                more, new = self.digit_after.match(low, end), self.digit[word]
                out.append((start, more.end() if more else end, new))
            elif word == "plus":
                if more := self.plus_after.match(low, end):
                    out.append((start, more.end(), "+"))
            elif word in AT_WORDS:
                if start > 1 and self.at_before.match(low, start - 2) and (more := self.at_after.match(low, end)):
                    out.append((start, more.end(), "@"))
            elif start > 1 and self.dot_before.match(low, start - 2) and (more := self.dot_after.match(low, end)):
                out.append((start, more.end(), "."))
        return sorted(out)

    def normal(self, text: str) -> tuple[str, list[tuple[int, int, int, bool]]]:
        """The text as it reads, and its stretches: (start in it, start and
        length in the source, whether a token stands for the source's part)."""
        special = not (text.isascii() or self.special.isdisjoint(text))
        plain = text.translate(self.chars) if special else text
        tokens = self._tokens(plain, special)
        if not tokens:
            return plain, [(0, 0, len(plain), False)]
        out: list[str] = []
        parts: list[tuple[int, int, int, bool]] = []
        made, at = 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal made
            if a < b:
                out.append(plain[a:b])
                parts.append((made, a, b - a, False))
                made += b - a

        for start, end, new in tokens:
            if start < at:                      # inside the token before
                continue
            if new in ("@", "."):               # white space before goes too
                while start > at and plain[start - 1].isspace():
                    start -= 1
            copy(at, start)
            if len(new) == end - start:         # character for character
                parts += [(made + k, start + k, 1, True) for k in range(len(new))]
            else:
                parts.append((made, start, end - start, True))
            out.append(new)
            made += len(new)
            at = end
        copy(at, len(plain))
        return "".join(out), parts

    def added(self, text: str, base: Sequence[Span]) -> list[Span]:
        """Spans of disguised identifiers, in code points of the text."""
        plain, parts = self.normal(text)
        if plain == text:
            return []
        starts = [p[0] for p in parts]
        had = {k: [(a, b) for i, a, b in base if i == k] for k in range(len(KINDS))}     # apart, in order
        out = []
        for kind, a, b in spans_of(plain):
            i, j = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
            while i and parts[i][3] and not len(plain[parts[i][0]:starts[i + 1] if i + 1 < len(starts) else None]):
                i -= 1
            first = parts[i][1] + (0 if parts[i][3] else a - parts[i][0])
            last = parts[j][1] + (parts[j][2] if parts[j][3] else b - parts[j][0])
            while last > first and text[last - 1] in " -," and parts[j][3]:
                last -= 1                       # a spelled digit takes what parts it from the next one
            beside = plain[a - 1:a] + " " + plain[b:b + 1]
            if text[first:last] == plain[a:b] or any(c.isalnum() for c in beside):
                continue
            if kind == 0 and not re.fullmatch("[A-Za-z]{2,}", plain[a:b].rpartition(".")[2]):
                continue
            before = bisect_right(had[kind], (first, len(text))) - 1
            if before < 0 or had[kind][before][1] < last:
                out.append((kind, first, last))
        return out


def described(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: Sequence[Span]) -> str:
    """The text with each stretch that spans cover replaced by its kind."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


RESULT = {**{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string", "n_added": "long", "redacted": "string"}


def find_pii(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", with_text: bool = False) -> DataFrame:
    """``keep``, number of base spans by kind, digest of the base spans, all
    spans, number of added ones (and the redacted text, if asked for)."""
    prepare(docs.sparkSession)
    names = list(RESULT) if with_text else [c for c in RESULT if c != "redacted"]
    docs, keep = without_clash(docs, keep, names)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), *(f"{c} {RESULT[c]}" for c in names)])
    kept = len(keep)

    def judge(batch: pa.RecordBatch):
        undo = Transducer.own()
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out: dict[str, list] = {c: [] for c in names}
            for t in part.column(kept).to_pylist():
                base = spans_of(t or "")
                more = undo.added(t, base) if t else []
                spans = sorted(base + more)
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(sha256(described(base).encode()).hexdigest())
                out["spans"].append(described(spans))
                out["n_added"].append(len(more))
                if with_text:
                    out["redacted"].append(redacted(t, spans) if t is not None else None)
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(kept)), *(pa.array(out[c], pa.string() if RESULT[c] == "string" else pa.int64()) for c in names)],
                                             names=[*keep, *names])

    return per_batch(docs.select(*(docs[k] for k in keep), docs[text]), judge, schema)
