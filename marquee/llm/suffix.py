"""Removal of passages that an earlier document holds, by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a
document with a smaller id.

1. *Copies.* Documents with the same bytes are one class; all of its members
   but those with the smallest id lose everything. From here on a class is its
   first document.
2. *Anchors.* The smallest hash among the ``GRAM``-byte strings inside a window of
   ``LENGTH`` bytes is the window's anchor. Equal windows have equal anchors,
   so windows whose anchor no other document has can't be repeated. Chunks of
   documents ask about each of their anchors once, whatever the number of
   their documents that have it.
3. *Suffix sorting.* Windows in a row that share a repeated anchor are one
   context. Contexts are dealt out by anchor, each distinct context of a chunk
   once with the smallest id that has it, so all equal windows meet in one
   task. An anchor whose contexts may have more than ``HOT_BYTES`` over all
   chunks is hot everywhere: each of its windows is a context of its own, dealt
   out by the hash of its bytes, so a short passage that many documents hold
   between different words fills no task. A message holds what a chunk has for
   several buckets, which the task sorts one by one, so their number doesn't
   limit the number of buckets. Equal contexts are one; those left that have no
   more in common with another one than their anchor (step 2 again, with longer
   strings) share no window, and each of their windows has their own smallest id.
   In the tasks the difference-cover algorithm sorts all suffixes of the others: the sampled
   triples (places 1 and 2 modulo 3) are sorted and named, the names are
   sorted by the same algorithm until they cover ``LENGTH`` bytes, the
   remaining suffixes follow from their first symbol and the rank of the next
   suffix, and both are merged. Adjacent suffixes are compared over ``LENGTH``
   bytes; each run of equal ones gets its smallest id.
4. Each chunk gets the smallest id of each of its windows, and cuts.

Nulls: a null text is empty; a null id sorts after all others. Rows that share
an id never remove from each other. Texts shorter than ``LENGTH`` bytes and
empty ones lose nothing. Very long texts are read whole (each is a chunk of
its own). Repeated rows get the same result. An empty table gives no rows;
other columns are left out. Kept bytes may not be valid UTF-8 where a cut
falls inside a character; ``kept`` as text drops such broken characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.text import quoted
from marquee.llm.common import NO_ID, chunk_id, mix, per_batch, prepare, ranges, written

#: Equal strings of GRAM bytes are rare by chance, also in a large corpus (of 16 bytes they were not); no result depends on it.
LENGTH, GRAM = 50, 24
#: Bytes that two equal windows share on one side of their anchor at least.
SIDE = (LENGTH - GRAM) // 2
#: Bytes of an anchor's contexts (a task sorts with some 160 bytes for each) from which its windows are dealt out one by one.
HOT_BYTES = 1 << 20
CHUNK_ROWS, CHUNK_BYTES, SLICE_BYTES = 1024, 4_000_000, 4_000_000
#: Bytes of the context of a run whose anchor is in all windows that can hold it; what tells numbers of hot runs from others.
FULL_RUN, HOT = 2 * LENGTH - GRAM, np.uint32(1 << 31)
ODD1, ODD2, ODD3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Buckets that share a message.
SHARE = 8


def words_at(raw: bytes | np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word that starts at each byte."""
    n = len(raw) - 7
    out = np.empty(max(0, n), "<u8")
    for k in range(min(8, n)):
        out[k::8] = np.frombuffer(raw, "<u8", (n - k + 7) // 8, k)
    return out


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place, of the words at each."""
    n = len(words) - GRAM + 8
    h = words[:n] * ODD1
    h += words[8:n + 8] * ODD3
    h += words[GRAM - 8:] * ODD2
    h ^= h >> np.uint64(32)
    h *= ODD2
    h ^= h >> np.uint64(29)
    return h


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and number of windows of each run of windows with the same anchor
    (a long text goes slice by slice; a run may end where a slice does)."""
    if len(raw) > 2 * SLICE_BYTES:
        parts = [anchors(raw[at:at + SLICE_BYTES + LENGTH - 1]) for at in range(0, len(raw) - LENGTH + 1, SLICE_BYTES)]
        return np.concatenate([a for a, _ in parts]), np.concatenate([n for _, n in parts])
    if len(raw) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = gram_hashes(words_at(raw))
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[:len(h) - (width - span)], h[width - span:])
    start = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
    return mix(h[start]), np.diff(np.append(start, len(h)))


def window_hashes(raw: bytes, places: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A hash of the ``length`` bytes at each place."""
    h = np.zeros(len(places), np.uint64)
    if len(places):
        w = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), 8)
        for k in [*range(0, length - 8, 8), length - 8]:
            h = mix(h * ODD1 + w[places + k].view("<u8").ravel())
    return h


def chunked(batches, text: int) -> Iterator[list[tuple]]:
    """Rows with their text as bytes, in lists of bounded size."""
    own, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i) if i == text else batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            raw = row[text].as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            own.append((*row[:text], raw, *row[text + 1:]))
            size += len(raw)
            if len(own) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                yield own
                own, size = [], 0
    if own:
        yield own


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def unpack_arrays(blob: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<i8", len(types) + 1)[1:]
    ends = np.cumsum([8 * (len(types) + 1), *sizes])
    return [np.frombuffer(blob, t, s // np.dtype(t).itemsize, e) for t, s, e in zip(types, sizes, ends[:-1], strict=True)]


# ---- step 2: which anchors are repeated ------------------------------------------------------------------------------

def _codes(buckets: int) -> str:
    """Type of a run's code: its bucket, or the largest number."""
    return "<u1" if buckets < 255 else "<u2" if buckets < 65_535 else "<u4"


def _ask_anchors(buckets: int):
    """Rows that begin with key and text -> messages (bucket, chunk, asked, several, weight, home).

    Each anchor of the chunk is asked about by its first run, with a bit that
    says whether several texts of the chunk have it, and the binary logarithm
    of the bytes of its contexts (rounded up; 0 if one full run would have as
    many). Home says where each run's answer will be: the bucket of a run that
    asks (the answers of a bucket come in the order of the runs), or ``top``
    for a run that repeats an earlier one, whose numbers follow. Anchors travel
    as 32 bits: within a bucket that is enough to tell nearly all apart, and a
    chance meeting only keeps a window that the sorting will drop.
    """
    kind = _codes(buckets)
    top = int(np.iinfo(kind).max)

    def run(batches):
        for number, rows in enumerate(chunked((b.select([0, 1]) for b in batches), 1)):
            found = [anchors(raw) for _, raw in rows]
            count = np.array([len(a) for a, _ in found], "<i8")
            h, size = (np.concatenate(x) for x in zip(*found, strict=True))
            texts: dict[bytes, int] = {}
            text = np.repeat(np.array([texts.setdefault(raw, len(texts)) for _, raw in rows]), count)
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, np.int64)
            least, most = ((f.reduceat(text[order], first) if len(h) else first) for f in (np.minimum, np.maximum))
            weight = np.add.reduceat((size + LENGTH - 1)[order], first) if len(h) else first
            asks = order[first]  # runs
            several, weigh = np.zeros(len(h), bool), np.zeros(len(h), np.uint8)
            several[asks] = least != most
            weigh[asks] = np.where(weight > FULL_RUN, np.ceil(np.log2(np.maximum(weight, 1))), 0)
            code = np.full(len(h), top, kind)
            bucket = _bucket(h, buckets)
            code[asks] = bucket[asks]
            leader = np.empty(len(h), np.int64)
            leader[order] = np.repeat(asks, np.diff(np.append(first, len(h))))
            asks = np.sort(asks)
            by_ask = asks[np.argsort(bucket[asks], kind="stable")]
            ends = np.searchsorted(bucket[by_ask], np.arange(buckets + 1))
            low = (h & np.uint64(0xFFFFFFFF)).astype("<u4")
            keys = np.array([r[0] for r in rows], "<i8")
            chunk = chunk_id(number, keys.tobytes() + count.tobytes())
            home = pack_arrays(keys, count, code, leader[code == top].astype("<u4"))
            used = np.union1d(bucket[asks], [chunk % buckets]).astype(np.int64)
            of = [by_ask[ends[b]:ends[b + 1]] for b in used]
            yield pa.RecordBatch.from_arrays([
                pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int64()), pa.array([low[o].tobytes() for o in of], pa.binary()),
                pa.array([np.packbits(several[o]).tobytes() for o in of], pa.binary()), pa.array([weigh[o].tobytes() for o in of], pa.binary()),
                pa.array([home if b == chunk % buckets else None for b in used], pa.binary())], names=["bucket", "chunk", "asked", "several", "weight", "home"])
    return run


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _bits(packed: Iterator[bytes], counts: Iterator[int]) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(x, np.uint8), count=int(n)).astype(bool) for x, n in zip(packed, counts, strict=True)]


def _answer_anchors(hot_bytes: int):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        """For each anchor asked about: is it repeated; and the numbers of the hot ones."""
        asked = np.frombuffer(b"".join(f["asked"]), "<u4")
        weigh = np.frombuffer(b"".join(f["weight"]), np.uint8).astype(np.int64)
        counts = [len(a) // 4 for a in f["asked"]]
        _, inverse, count = np.unique(asked, return_inverse=True, return_counts=True)
        again = (count[inverse] > 1) | np.concatenate(_bits(f["several"], counts))
        weight = np.bincount(inverse, np.where(weigh, 1 << weigh, FULL_RUN))
        hot = again & (weight[inverse] > hot_bytes)
        ends = np.cumsum([0, *counts])
        parts = list(zip(ends[:-1], ends[1:], strict=True))
        return pd.DataFrame({"chunk": f["chunk"], "bucket": f["bucket"], "again": [np.packbits(again[a:b]).tobytes() for a, b in parts],
                             "hot": [np.flatnonzero(hot[a:b]).astype("<u4").tobytes() for a, b in parts], "home": f["home"]})
    return run


def _mark(buckets: int):
    kind = _codes(buckets)
    top = int(np.iinfo(kind).max)

    def run(f: pd.DataFrame) -> pd.DataFrame:
        """(key, runs): the numbers of each document's runs whose anchor is repeated, ``HOT`` more if it is hot."""
        home = next(x for x in f["home"] if x is not None)
        keys, count, code, leader = unpack_arrays(home, "<i8", "<i8", kind, "<u4")
        asks = np.flatnonzero(code < top)
        asks = asks[np.argsort(code[asks], kind="stable")]
        f = f.sort_values("bucket")
        ends = np.searchsorted(code[asks], np.append(f["bucket"].to_numpy(), buckets))
        hit, hot = np.zeros(len(code), bool), np.zeros(len(code), "<u4")
        hit[asks] = np.concatenate(_bits(f["again"], np.diff(ends)))
        for at, x in zip(ends, f["hot"]):
            hot[asks[at + np.frombuffer(x, "<u4")]] = HOT
        hit[code == top], hot[code == top] = hit[leader], hot[leader]
        out: dict[str, list] = {"key": [], "runs": []}
        ends = np.cumsum([0, *count])
        for k, a, b in zip(keys, ends[:-1], ends[1:], strict=True):
            at = np.flatnonzero(hit[a:b])
            if len(at):
                out["key"].append(k)
                out["runs"].append((at.astype("<u4") | hot[a:b][at]).tobytes())
        return pd.DataFrame(out)
    return run


# ---- step 3: suffix sorting ------------------------------------------------------------------------------------------

def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number that sorts as the pair (a, b); both hold non-negative numbers."""
    bits = int(b.max(initial=0)).bit_length()
    if int(a.max(initial=0)).bit_length() + bits > 62:
        a = np.unique(a, return_inverse=True)[1]
    return (a.astype(np.int64) << bits) | b


def suffix_ranks(t: np.ndarray, covers: int, enough: int) -> np.ndarray:
    """Places of all suffixes of ``t`` in sorted order, decided by their first ``enough`` units at least.

    ``t`` holds symbols from 1 on that cover ``covers`` units each, and 0 after
    the end of each string; its length is a multiple of 3. Suffixes that agree
    so far come in any order.
    """
    n = len(t)
    after = np.concatenate([t, np.zeros(3, t.dtype)])
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sampled = np.concatenate([one, two])
    triple = pair_key(pair_key(after[sampled], after[sampled + 1]), after[sampled + 2])
    order = np.argsort(triple)
    new = np.append(True, triple[order[1:]] != triple[order[:-1]])
    place = np.empty(len(sampled), np.int64)
    if 3 * covers >= enough or new.all():
        place[order] = np.arange(len(order))
    else:
        half = len(one)
        gap = 3 - half % 3
        names = np.empty(len(sampled), np.int64)
        names[order] = np.cumsum(new)
        sub = np.zeros(2 * (half + gap), np.int64)  # the names of places 1, 4, ..., then of 2, 5, ..., each with an end
        sub[:half], sub[half + gap:2 * half + gap] = names[:half], names[half:]
        found = suffix_ranks(sub, 3 * covers, enough)
        found = np.concatenate([found[:half], found[half + gap:2 * half + gap]])
        there = np.zeros(len(sub), np.int64)
        there[found] = 1
        place = np.cumsum(there)[found] - 1  # without the ends
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = place + 1
    rest = np.arange(0, n, 3)
    # the remaining suffixes: against places 1 by (symbol, next rank), against places 2 by (symbol, symbol, rank after)
    key1 = pair_key(np.concatenate([after[rest], after[one]]), np.concatenate([rank[rest + 1], rank[one + 1]]))
    key2 = pair_key(pair_key(np.concatenate([after[rest], after[two]]), np.concatenate([after[rest + 1], after[two + 1]])),
                    np.concatenate([rank[rest + 2], rank[two + 2]]))
    m = len(rest)
    order = np.argsort(key1[:m])
    below = np.searchsorted(np.sort(key1[m:]), key1[order]) + np.searchsorted(np.sort(key2[m:]), key2[order])
    if (below[1:] < below[:-1]).any():  # only among suffixes that agree so far
        again = np.argsort(below, kind="stable")
        order, below = order[again], below[again]
    out = np.empty(n, np.int64)
    at = below + np.arange(m)
    out[rest[order]] = at
    free = np.ones(n, bool)
    free[at] = False
    by_place = np.empty(len(sampled), np.int64)
    by_place[place] = sampled
    out[by_place] = np.flatnonzero(free)
    return out


def smallest_ids(strings: list[bytes], ids: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each window of ``length`` bytes of the strings, in order: the smallest id of a string that holds it."""
    size = np.array([len(s) for s in strings], np.int64)
    if not size.sum():
        return np.zeros(0, np.int64)
    room = size + 3 - size % 3
    start = np.cumsum(room) - room
    raw = b"".join(s + b"\0" * int(r - len(s)) for s, r in zip(strings, room, strict=True))
    t = np.frombuffer(raw, np.uint8).astype(np.int64) + 1
    for k in range(1, 4):  # room - size is 1 to 3
        end = start + room - k
        t[end[end >= start + size]] = 0
    rank = suffix_ranks(t, 1, length)
    windows = np.maximum(size - length + 1, 0)
    places = ranges(start, windows)
    window_at = np.full(len(t), -1, np.int64)
    window_at[places] = np.arange(len(places))
    sorted_suffixes = np.empty(len(t), np.int64)
    sorted_suffixes[rank] = np.arange(len(t))
    order = window_at[sorted_suffixes]
    order = order[order >= 0]
    at = places[order]
    words = words_at(raw + b"\0" * 8)
    same = np.ones(max(0, len(at) - 1), bool)
    for k in [*range(0, length - 8, 8), length - 8]:
        w = words[at + k]
        same &= w[1:] == w[:-1]
    first = np.flatnonzero(np.append(True, ~same)) if len(at) else np.zeros(0, np.int64)
    owner = np.repeat(ids, windows)
    out = np.empty(len(at), np.int64)
    if len(at):
        out[order] = np.repeat(np.minimum.reduceat(owner[order], first), np.diff(np.append(first, len(at))))
    return out


def _distinct(raw: bytes, start: np.ndarray, length: np.ndarray, ids: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different strings of ``raw`` at these places; the number of each place's string; the smallest id of each string."""
    seen: dict[bytes, int] = {}
    number = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), (start + length).tolist(), strict=True)], np.int64)
    least = np.full(len(seen), NO_ID, "<i8")
    np.minimum.at(least, number, ids)
    return list(seen), number, least


def _ask_contexts(buckets: int):
    """(key, text, id, runs) rows -> messages (bucket, chunk, contexts, sizes, ids, within, home).

    A message is for ``SHARE`` buckets in a row, the first divided by ``SHARE``
    its own number; ``within`` is the number of contexts for each of them.
    """
    def run(batches):
        for serial, rows in enumerate(chunked(batches, 1)):
            found = []
            for _, raw, _, runs, *_ in rows:
                anchor, size = anchors(raw)
                runs = np.frombuffer(runs, "<u4")
                hot = runs >= HOT
                at = np.cumsum(size) - size
                cold, runs = runs[~hot], runs[hot] - HOT
                single = ranges(at[runs], size[runs])
                found.append((np.append(at[cold], single), np.append(size[cold], np.ones(len(single), np.int64)),
                              np.append(_bucket(anchor[cold], buckets), _bucket(window_hashes(raw, single), buckets))))
            sizes = np.array([len(first) for first, _, _ in found], "<i8")
            firsts, windows, every = (np.concatenate(x) for x in zip(*found, strict=True))
            length = windows + LENGTH - 1
            start = firsts + np.repeat(np.cumsum([0, *(len(r[1]) for r in rows[:-1])]), sizes)
            contexts, number, least = _distinct(b"".join(r[1] for r in rows), start, length, np.repeat(np.array([r[2] for r in rows], "<i8"), sizes))
            bucket, size = np.empty(len(contexts), np.int64), np.empty(len(contexts), "<u4")  # equal bytes have one anchor, so one bucket
            bucket[number], size[number] = every, length
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + SHARE))  # of a bucket past the last one, too: the last message may have fewer
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            keys = np.array([r[0] for r in rows], "<i8")
            chunk = chunk_id(serial, keys.tobytes())
            home = pack_arrays(keys, np.array([r[2] for r in rows], "<i8"), np.array([len(r[1]) for r in rows], "<i8"), sizes,
                               firsts.astype("<u4"), place[number].astype("<u4"), size[order])
            at_home = chunk % buckets // SHARE
            used = np.union1d(bucket // SHARE, [at_home]).astype(np.int64)
            starts = ends[SHARE * used[:, None] + np.arange(SHARE + 1)]
            of = [order[a:b] for a, b in starts[:, [0, -1]].tolist()]
            within = np.diff(starts).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int64()), pa.array([b"".join([contexts[k] for k in o.tolist()]) for o in of], pa.binary()),
                pa.array([size[o].tobytes() for o in of], pa.binary()), pa.array([least[o].tobytes() for o in of], pa.binary()),
                pa.array([x.tobytes() for x in within], pa.binary()), pa.array([home if b == at_home else None for b in used], pa.binary())],
                names=["bucket", "chunk", "contexts", "sizes", "ids", "within", "home"])
    return run


def _near(strings: list[bytes]) -> np.ndarray:
    """For each of different contexts: may it share a window with another one?

    All windows of a context have its smallest gram hash. Equal windows hold
    that gram at the same place, with ``SIDE`` equal bytes before or after it.
    """
    size = np.array([len(s) for s in strings], np.int64)
    end = np.cumsum(size)
    start = end - size
    raw = b"".join(strings)
    h = gram_hashes(words_at(raw + b"\0" * (GRAM - 1)))  # one a byte
    h[(end[:, None] - np.arange(1, GRAM)).ravel()] = np.iinfo(np.uint64).max  # these cross an end
    at = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, start), size))
    owner = np.repeat(np.arange(len(size)), size)[at]
    before, after = at - SIDE >= start[owner], at + GRAM + SIDE <= end[owner]
    key = np.concatenate([window_hashes(raw, at[before] - SIDE, GRAM + SIDE), ~window_hashes(raw, at[after], GRAM + SIDE)])
    owner = np.concatenate([owner[before], owner[after]])
    near = np.zeros(len(size), bool)
    if len(key):
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        near[owner[np.repeat(several, np.diff(np.append(first, len(key))))]] = True
    return near


def _answer_contexts(f: pd.DataFrame) -> pd.DataFrame:
    """The smallest id of each window of each chunk's contexts, as runs of (id, windows)."""
    length, ids = (np.frombuffer(b"".join(f[c]), t).astype(np.int64) for c, t in (("sizes", "<u4"), ("ids", "<i8")))
    strings, number, least = _distinct(b"".join(f["contexts"]), np.cumsum(length) - length, length, ids)
    numbers = np.split(number, np.cumsum([len(x) // 4 for x in f["sizes"]])[:-1])
    windows = np.array([max(0, len(s) - LENGTH + 1) for s in strings], np.int64)
    start = np.cumsum(windows) - windows
    near = _near(strings) if strings else np.zeros(0, bool)
    least_of = np.repeat(least, windows)
    least_of[np.repeat(near, windows)] = smallest_ids([s for s, x in zip(strings, near, strict=True) if x], least[near])
    values, lengths = [], []
    for own in numbers:
        v = least_of[ranges(start[own], windows[own])]
        cut = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
        values.append(v[cut].astype("<i8").tobytes())
        lengths.append(np.diff(np.append(cut, len(v))).astype("<u4").tobytes())
    return pd.DataFrame({"chunk": f["chunk"], "bucket": f["bucket"], "ids": values, "sizes": lengths, "home": f["home"]})


def _answer_messages(answer):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        """``answer`` to messages, bucket by bucket over all chunks."""
        within = np.frombuffer(b"".join(f["within"]), "<u4").astype(np.int64)  # contexts by (message, bucket)
        size, ids = (np.frombuffer(b"".join(f[c]), t) for c, t in (("sizes", "<u4"), ("ids", "<i8")))
        size = size.astype(np.int64)
        last = np.cumsum(within)
        total, windows = (np.diff(np.concatenate([[0], np.cumsum(x)])[np.append(0, last)]) for x in (size, size - LENGTH + 1))
        upto = np.cumsum(total.reshape(-1, SHARE), axis=1)
        pieces = [blob[a:b] for blob, row in zip(f["contexts"], upto.tolist(), strict=True) for a, b in zip([0, *row], row)]
        least = []
        for k in range(SHARE):
            own = ranges(last[k::SHARE] - within[k::SHARE], within[k::SHARE])
            if len(own):
                one = pd.DataFrame({"chunk": [0], "bucket": [k], "contexts": [b"".join(pieces[k::SHARE])], "sizes": [size[own].astype("<u4").tobytes()],
                                    "ids": [ids[own].tobytes()], "home": [None]})
                found = answer(one)
                least.append(np.repeat(np.frombuffer(found["ids"][0], "<i8"), np.frombuffer(found["sizes"][0], "<u4")))
        # by (bucket, message) so far; a message gets those of its buckets together
        by = windows.reshape(-1, SHARE).T.ravel()
        start = (np.cumsum(by) - by).reshape(SHARE, -1).T.ravel()
        v = np.concatenate([np.zeros(0, np.int64), *least])[ranges(start, windows)]
        ends = np.cumsum(windows.reshape(-1, SHARE).sum(axis=1))
        cut = np.union1d(np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64), ends[ends < len(v)])
        values, lengths, at = v[cut].astype("<i8"), np.diff(np.append(cut, len(v))).astype("<u4"), np.searchsorted(cut, np.append(0, ends)).tolist()
        return pd.DataFrame({"chunk": f["chunk"], "bucket": f["bucket"], "ids": [values[a:b].tobytes() for a, b in zip(at, at[1:])],
                             "sizes": [lengths[a:b].tobytes() for a, b in zip(at, at[1:])], "home": f["home"]})
    return run


def _spans(f: pd.DataFrame) -> pd.DataFrame:
    """(key, spans): the removed runs of bytes of each document that loses some, as (start, end) pairs."""
    home = next(x for x in f["home"] if x is not None)
    keys, ids, length, count, first, place, size = unpack_arrays(home, "<i8", "<i8", "<i8", "<i8", "<u4", "<u4", "<u4")
    f = f.sort_values("bucket")
    least = np.repeat(np.frombuffer(b"".join(f["ids"]), "<i8"), np.frombuffer(b"".join(f["sizes"]), "<u4"))
    windows = size.astype(np.int64) - LENGTH + 1
    start = np.cumsum(windows) - windows
    out: dict[str, list] = {"key": [], "spans": []}
    ends = np.cumsum([0, *count])
    for i, key in enumerate(keys):
        a, b = ends[i], ends[i + 1]
        p = place[a:b]
        gone = least[ranges(start[p], windows[p])] < ids[i]
        if not gone.any():
            continue
        at = np.sort(ranges(first[a:b].astype(np.int64), windows[p])[gone])
        new = np.append(True, at[1:] > at[:-1] + LENGTH)  # spans that touch are one
        out["key"].append(key)
        out["spans"].append(np.stack([at[new], at[np.append(new[1:], True)] + LENGTH], axis=1).astype("<i8").tobytes())
    return pd.DataFrame(out)


class Repeats:
    """The plan's parts, all lazy:

    documents: id, key, n_bytes, sha256 of the whole text, first_id and
    first_key of its class; texts: key, text, id and the ``extra`` columns;
    spans: key and removed (start, end) bytes of first documents that lose some.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", extra: Sequence[Column] = ()):
        spark = prepare(docs.sparkSession)
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets, small = width, 16 * width  # sorting holds some 20 numbers a byte of a bucket's contexts
        key = F.xxhash64(docs[id_col], docs[text])
        id_ = F.coalesce(docs[id_col], F.lit(NO_ID)).cast("long")
        whole = F.coalesce(docs[text], F.lit(""))
        ident = docs.select(id_.alias("id"), key.alias("key"), F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("sha256"))
        classes = written(ident.groupBy("sha256").agg(F.min(F.struct("id", "key")).alias("m"))
                          .select("sha256", F.col("m.id").alias("first_id"), F.col("m.key").alias("first_key")))
        # the texts go by key three times, each time with all of these columns: Spark shuffles them once and reads that again
        self.texts = docs.select(key.alias("key"), whole.alias("text"), id_.alias("id"), *(c.alias(f"_x{i}") for i, c in enumerate(extra)))
        self.extra = [f"_x{i}" for i in range(len(extra))]
        firsts = classes.select(F.col("first_key").alias("key"))
        asked = self.texts.join(firsts.hint("shuffle_hash"), "key", "left_semi").mapInArrow(_ask_anchors(buckets), "bucket int, chunk long, asked binary, several binary, weight binary, home binary")
        answers = asked.groupBy("bucket").applyInPandas(_answer_anchors(HOT_BYTES), "chunk long, bucket int, again binary, hot binary, home binary")
        marks = answers.groupBy("chunk").applyInPandas(_mark(buckets), "key long, runs binary")
        marked = self.texts.join(marks, "key").groupBy("key").agg(*(F.first(c).alias(c) for c in ("text", "id", "runs", *self.extra)))
        asked = marked.mapInArrow(_ask_contexts(small), "bucket int, chunk long, contexts binary, sizes binary, ids binary, within binary, home binary")
        answers = asked.groupBy("bucket").applyInPandas(_answer_messages(_answer_contexts), "chunk long, bucket int, ids binary, sizes binary, home binary")
        self.spans = answers.groupBy("chunk").applyInPandas(_spans, "key long, spans binary")
        self.documents = ident.join(classes, "sha256")


def without_spans(raw: bytes, spans: bytes | None) -> tuple[bytes, int, int]:
    """What is left, the bytes removed, and their runs."""
    s = np.frombuffer(spans or b"", "<i8").reshape(-1, 2)
    if not len(s):
        return raw, 0, 0
    left = b"".join(raw[a:b] for a, b in zip([0, *s[:, 1].tolist()], [*s[:, 0].tolist(), len(raw)], strict=True))
    return left, int((s[:, 1] - s[:, 0]).sum()), len(s)


def _digests(batch: pa.RecordBatch):
    found = [without_spans(t.as_buffer().to_pybytes(), s) for t, s in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True)]
    yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
                                      pa.array([sha256(f[0]).hexdigest() for f in found], pa.string())], names=["key", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` less its repeated bytes; rows that lose bytes and keep only white space go."""
    rest = [c for c in docs.columns if c != text]
    parts = Repeats(docs, id_col, text, [docs[text].isNull(), *(docs[c] for c in rest)])
    copies = parts.documents.where((F.col("id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)).select("key").distinct()
    left = parts.texts.join(parts.spans, "key", "left").join(copies, "key", "left_anti").select("text", "spans", *parts.extra, "id")
    types = {f.name: f.dataType.simpleString() for f in docs.schema}

    def apply(batch: pa.RecordBatch):
        texts, keep = [], []
        for raw, spans, null in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            t = without_spans(raw.as_buffer().to_pybytes(), spans)[0].decode("utf-8", "ignore") if spans else raw.as_py()
            texts.append(None if null else t)
            keep.append(not spans or bool(t.strip()))
        out = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *(batch.column(3 + i) for i in range(len(rest)))], names=[text, *rest])
        yield out.filter(pa.array(keep))

    schema = ", ".join([f"{quoted(text)} string", *(f"{quoted(c)} {types[c]}" for c in rest)])
    return per_batch(left, apply, schema).select(*(F.col(quoted(c)) for c in docs.columns))


EMPTY_SHA = sha256(b"").hexdigest()


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    parts = Repeats(docs, id_col, text)
    lost = parts.texts.join(parts.spans, "key").groupBy("key").agg(*(F.first(c).alias(c) for c in ("text", "id", "spans")))
    digest = per_batch(lost.select("key", "text", "spans", "id"), _digests, "key long, n_removed long, n_spans long, kept string").withColumnRenamed("key", "first_key")
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    own = F.col("id") == F.col("first_id")
    pick = lambda c, whole, none: F.when(copy, whole).when(own & F.col("n_removed").isNotNull(), F.col(c)).otherwise(none)
    return parts.documents.join(digest, "first_key", "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "n_bytes", pick("n_removed", F.col("n_bytes"), F.lit(0)).cast("long").alias("n_removed"),
        pick("n_spans", F.lit(1), F.lit(0)).cast("long").alias("n_spans"), pick("kept", F.lit(EMPTY_SHA), F.col("sha256")).alias("kept_sha256"))
