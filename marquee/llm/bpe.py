"""Byte-level BPE over a rank file, and its inverse.

Two tiers. A pre-token that is a vocabulary entry is found by a minimal
perfect hash over the vocabulary: one bucket displacement, one slot, one
comparison. Any other pre-token is merged bottom up: its bytes form a doubly
linked list, a heap holds the mergeable neighbours by (rank, place), and each
merge replaces two links by one and offers at most two new neighbours, so a
pre-token of n bytes costs O(n log n) however long it is. Up to ``SHORT``
bytes the least neighbour is looked for among all, which costs less there.

The pattern is one whose pre-tokens never run from a letter over a blank to
another letter; long texts are split there, so memory follows a slice.

Nulls and empty texts have no ids; decoding gives the empty byte string. Very
long texts are encoded whole. Repeated rows give repeated results. Merges of
equal rank go from left to right. An empty table gives no rows. Other columns
than ``keep`` are left out; a kept one named like a result gets ``_kept`` after
its name.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Sequence
from hashlib import sha256
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.common import Memo, prepare, without_clash


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys.

    Keys fall into buckets by one hash; buckets, the largest first, take the
    smallest displacement (a shift, and a multiple of each key's own step) that
    sends all of their keys to free slots.
    """

    def __init__(self, keys: Sequence[bytes], values: Sequence[int]):
        self.n = n = len(keys)
        self.n_buckets = max(1, n // 3)
        self.shift = [0] * self.n_buckets
        buckets: list[list[int]] = [[] for _ in range(self.n_buckets)]
        for i, k in enumerate(keys):
            buckets[self._hash(k)[0] % self.n_buckets].append(i)
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        free = bytearray(b"\1") * n
        spare = n - 1
        for b in sorted(range(self.n_buckets), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if not own:
                break
            if len(own) == 1:  # any free slot will do: stored as a negative number
                while not free[spare]:
                    spare -= 1
                self.shift[b], slots = -spare - 1, [spare]
            else:
                hashes = [self._hash(keys[i])[1:] for i in own]
                d = 0
                while True:
                    slots = [(x + d // n * y + d) % n for x, y in hashes]
                    if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                        break
                    d += 1
                    if d > n * n + 1000:
                        raise ValueError("two keys share their hashes")
                self.shift[b] = d
            for i, s in zip(own, slots, strict=True):
                free[s] = 0
                self.keys[s], self.values[s] = keys[i], values[i]

    @staticmethod
    def _hash(key: bytes) -> tuple[int, int, int]:
        """For the bucket, the first slot, and the step."""
        h = xxhash.xxh3_128_intdigest(key)
        return h & 0xFFFFFFFF, h >> 32 & 0xFFFFFFFF, h >> 64

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        bucket, x, y = self._hash(key)
        d = self.shift[bucket % self.n_buckets]
        if d < 0:
            slot = -d - 1
        else:
            slot = (x + d // self.n * y + d) % self.n
        return self.values[slot] if self.keys[slot] == key else None


#: Bytes up to which looking through all neighbours is faster than a heap.
SHORT = 48
NO_RANK = 1 << 62


def merge_short(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge_bytes`` of a short pre-token: the least rank of all neighbours, the first of equal ones."""
    rank = ranks.get
    parts = [token[i:i + 1] for i in range(len(token))]
    pairs = [rank(token[i:i + 2], NO_RANK) for i in range(len(token) - 1)]
    while pairs and (least := min(pairs)) != NO_RANK:
        i = pairs.index(least)
        parts[i] = part = parts[i] + parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(part + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + part, NO_RANK)
    return [ranks[p] for p in parts]


def merge_bytes(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no vocabulary entry."""
    n = len(token)
    if n <= SHORT:
        return merge_short(token, ranks)
    end = list(range(1, n + 1))      # the part that starts at i ends at end[i]
    left = list(range(-1, n - 1))    # where the part before the one at i starts
    heap = []
    for i in range(n - 1):
        r = ranks.get(token[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        r, i, to = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != to:
            continue  # one of the two parts has been merged meanwhile
        end[mid], end[i] = 0, to
        if to < n:
            left[to] = i
            x = ranks.get(token[i:end[to]])
            if x is not None:
                heapq.heappush(heap, (x, i, end[to]))
        if i:
            before = left[i]
            x = ranks.get(token[before:to])
            if x is not None:
                heapq.heappush(heap, (x, before, to))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[token[i:end[i]]])
        i = end[i]
    return ids


#: Characters of a text that are split into pre-tokens at once.
AT_ONCE = 2_000_000


def slices(text: str, cut, most: int = AT_ONCE):
    """The text in slices of about ``most`` characters, parted only where ``cut`` (a pattern) fits."""
    at = 0
    while len(text) - at > most:
        m = cut.search(text, at + most)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


#: Pre-tokens whose ids a worker keeps.
KNOWN = 500_000


class Codec:
    """Encoder and decoder of one rank file; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash | None = None):
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        # between a letter and a blank before a letter no pre-token goes on
        self.cut = regex.compile(r"(?<=\p{L}) (?=\p{L})")
        self.hashed = hashed or PerfectHash(list(ranks), list(ranks.values()))
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.memo = Memo(self._ids, KNOWN)

    def _ids(self, token: str) -> bytes:
        raw = token.encode()
        whole = self.hashed.get(raw)
        if whole is not None:
            return whole.to_bytes(4, "little")
        ids = merge_bytes(raw, self.ranks)
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return b"".join(b"".join(map(self.memo.__getitem__, self.find(part))) for part in slices(text, self.cut))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _mapped(docs: DataFrame, keep: Sequence[str], column: str, more: str, fn) -> DataFrame:
    docs, keep = without_clash(docs, keep, (c.split()[0] for c in more.split(", ")))
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), more])
    kept = len(keep)

    def run(batches):
        made = None
        for batch in batches:
            made = made or fn()
            for at in range(0, batch.num_rows, 256):  # short slices bound what Python holds
                part = batch.slice(at, 256)
                arrays, names = made(part.column(kept).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(kept)), *arrays], names=[*keep, *names])

    return docs.select(*(docs[k] for k in keep), docs[column]).mapInArrow(run, schema)


_MADE: dict[str, Codec] = {}


def worker_codec(name: str, shared, pattern: str) -> Codec:
    """The codec of this Python worker: its later tasks know the pre-tokens of the earlier ones."""
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Codec(shared.value[0], pattern, shared.value[1])
    return _MADE[name]


def codec_source(spark: SparkSession, ranks_path: str, pattern: str):
    """Broadcast of the ranks and their hash; its size is the rank file's."""
    ranks = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((ranks, PerfectHash(list(ranks), list(ranks.values()))))
    name = uuid.uuid4().hex
    return lambda: worker_codec(name, shared, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep: Sequence[str] = ("doc_id",),
                     text: str = "text") -> DataFrame:
    """``keep``, n_tokens, ids (binary: little-endian unsigned 32-bit)."""
    source = codec_source(prepare(docs.sparkSession), ranks_path, pattern)

    def fn():
        codec = source()

        def run(texts):
            ids = [codec.encode(t) for t in texts]
            return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["n_tokens", "ids"]
        return run

    return _mapped(docs, keep, text, "n_tokens long, ids binary", fn)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, keep: Sequence[str] = ("doc_id",),
                     ids: str = "ids") -> DataFrame:
    """``keep``, decoded (binary); null ids decode to the empty string."""
    source = codec_source(prepare(encoded.sparkSession), ranks_path, pattern)

    def fn():
        codec = source()
        return lambda rows: ([pa.array([codec.decode(x or b"") for x in rows], pa.binary())], ["decoded"])

    return _mapped(encoded, keep, ids, "decoded binary", fn)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, keep: Sequence[str] = ("doc_id",),
               text: str = "text") -> DataFrame:
    """``keep``, n_tokens, ids_sha256, decoded_sha256: encode, decode the ids,
    and keep the digests, all in one pass over the texts."""
    source = codec_source(prepare(docs.sparkSession), ranks_path, pattern)

    def fn():
        codec = source()

        def run(texts):
            ids = [codec.encode(t) for t in texts]
            return [pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([sha256(codec.decode(x)).hexdigest() for x in ids], pa.string())], \
                ["n_tokens", "ids_sha256", "decoded_sha256"]
        return run

    return _mapped(docs, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", fn)
