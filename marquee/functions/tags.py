"""Multi-valued tag column: split, trim, correct, de-duplicate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import strip

# The reference's genre corrections (typos and foreign names
# to standard names), in the reference's order.
GENRE_CORRECTIONS = {
    "Horor": "Horror",
    "Mistery": "Mystery",
    "Misterija": "Mystery",
    "Krimi": "Crime",
    "Komedija": "Comedy",
    "Akcija": "Action",
    "Romantic Drama": "Drama",
    "Comedy-Drama": "Drama",
    "Crime Drama": "Crime",
    "Sports Drama": "Drama",
    "War Drama": "Drama",
    "Historical Drama": "Drama",
    "Thriller": "Thriller",
    "Avant-Garde": "Documentary",
}


def dictionary_lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """``mapping.get(c, c)`` as one map literal (exact, case-sensitive)."""
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def clean_tag_list(c: Column | str, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
                   sep: str = ",") -> Column:
    """'Action, Horor,Action' -> ['Action', 'Horror'].

    Split on ``sep`` (empty pieces kept), strip each piece, apply the
    dictionary, then drop repeats keeping the first position. NULL stays
    NULL (it explodes to no rows)."""
    c = F.col(c) if isinstance(c, str) else c
    pieces = F.split(c, _regex_escape(sep), -1)
    stripped = F.transform(pieces, strip)       # a lookup names its piece twice
    fixed = F.transform(stripped, lambda x: dictionary_lookup(x, mapping))
    return F.array_distinct(fixed)


def split_stripped(c: Column, sep: str = ",") -> Column:
    """Split on ``sep`` with every piece stripped (Python ``[p.strip() for p
    in s.split(sep)]``): strip the whole string once, then split on the
    separator with any whitespace around it; empty pieces are kept."""
    from marquee.functions.text import WS_CLASS
    return F.split(strip(c), f"{WS_CLASS}*{_regex_escape(sep)}{WS_CLASS}*", -1)


def ordered_repeat_join(pairs: Column, sep: str = ", ") -> Column:
    """Join an array of struct(tag, n) into one string with each tag repeated
    n times, tags in byte order: the ordered string aggregate computed from
    per-tag counts instead of every row. Raises when n is beyond an int: such
    a string could not be held."""
    ordered = F.sort_array(pairs)
    return F.array_join(F.transform(
        ordered, lambda p: F.array_join(F.array_repeat(p.getField("tag"), p.getField("n").cast("int")), sep)), sep)


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)
