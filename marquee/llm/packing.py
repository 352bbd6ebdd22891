"""Packing of tokenised documents into sequences of a fixed length.

1. Each document is tokenised where it is read; a document longer than a
   sequence is cut into full pieces and one rest. Pieces are written as small
   rows (no text).
2. The corpus is summed up as a histogram: how many pieces have each length.
   It has at most ``capacity`` rows whatever the corpus holds, so the driver
   can plan on it (``plan_bins``): bin completion takes the largest length
   left, enumerates the undominated fillings of the space beside it by branch
   and bound, and repeats the best filling as often as the counts allow. That
   leaves fewer pieces of one of its lengths than the pattern holds, so a
   length x ends at most 1 + capacity / x patterns, and a plan has at most
   capacity * (2 + ln capacity) of them whatever the corpus holds.
3. A piece finds its place by its rank among the pieces of its length:
   counts of each input partition are summed up first, so a rank needs no
   task that sees all pieces of a length.

Nulls: null and empty texts are one piece that holds the end id alone; null
ids are kept as they are. Repeated rows and repeated ids are documents of
their own. Ties between equal lengths go by partition and order in it. An
empty table gives no rows. Other columns than ``keep`` are left out; a kept one
named like a result gets ``_kept`` after its name.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import prepare, without_clash, written

CAPACITY = 2048
END_ID = 0
#: Choices of a length and its copies tried for one bin before the best filling so far is taken.
BRANCHES = 5000


#: Bytes of ids that a Python worker keeps in a generation of its cache.
CACHE_BYTES = 80_000_000
#: Names of the result's columns and of those on the way to it.
OWN = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "_part", "_row", "_n", "_rank", "_in", "_first")


class WordCache:
    """Ids of texts from the ids of their words.

    The tokenizer drops white space and encodes its pre-tokens (letters, one
    digit, contractions, other signs) apart. In texts of ASCII and Latin-1
    letters these can be told by the pattern below, so a Python worker keeps the
    ids of pre-tokens over all of its tasks; other runs without white space are
    kept whole. New ones of a slice of texts are encoded together: a pre-token
    ends at an id that ends a word, runs are parted by the end-of-text token.
    Runs that hold the text of a special token are encoded one by one, as the
    plain call would.

    The cache has two generations: when the younger has grown to ``LIMIT`` bytes
    it becomes the older, whose entries are moved on when they are met again, so
    what is common stays and the memory is bounded whatever the vocabulary.
    """

    LIMIT, TOGETHER, PARTED, PART, PART_ID = CACHE_BYTES, 1000, 200, "<|endoftext|>", 49407
    SPECIAL = ("<|startoftext|>", "<|endoftext|>")
    PER_ENTRY = 200                     # bytes of an entry beside its key and its ids
    _own: dict[str, WordCache] = {}

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs = re.compile(r"[^ \t-\r]+").findall
        self.plain = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*").fullmatch
        self.words = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+").findall
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    @classmethod
    def of(cls, path: str) -> WordCache:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _parts(self, text: str | None) -> list[str]:
        """Pre-tokens of a text, or whole runs where the pattern can't tell."""
        if not text:
            return []
        special = "<|" in text and any(x in text for x in self.SPECIAL)
        if not special and self.plain(text):
            return self.words(text.lower())
        return list(chain.from_iterable(self.words(r.lower()) if self.plain(r) and not (special and any(x in r for x in self.SPECIAL)) else [r]
                                        for r in self.runs(text)))

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of one kind: pre-tokens, or runs without special tokens."""
        if self.plain(parts[0]):
            ids = self._ids(" ".join(parts))
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            starts, ends = [0, *cuts[:-1]], cuts
        else:
            ids = self._ids(self.PART.join(parts))
            cuts = (4 * np.flatnonzero(ids == self.PART_ID)).tolist()
            starts, ends = [0, *(c + 4 for c in cuts)], [*cuts, 4 * len(ids)]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(starts, ends, strict=True)]

    def _learn(self, parts: list[str]) -> None:
        words, runs = [], []
        for x in parts:
            if any(s in x for s in self.SPECIAL):
                self._keep(x, self._ids(x).tobytes())
            else:
                (words if self.plain(x) else runs).append(x)
        for kind, together in ((words, self.TOGETHER), (runs, self.PARTED)):
            for at in range(0, len(kind), together):
                part = kind[at:at + together]
                for x, ids in zip(part, self._encode(part), strict=True):
                    self._keep(x, ids)

    def _keep(self, part: str, ids: bytes) -> None:
        self.young[part] = ids
        self.size += len(part) + len(ids) + self.PER_ENTRY

    def ids(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without the end id."""
        parts = [self._parts(t) for t in texts]
        new = []
        for x in set(chain.from_iterable(parts)).difference(self.young):
            if x in self.old:
                self._keep(x, self.old[x])
            else:
                new.append(x)
        self._learn(new)
        out = [b"".join(map(self.young.__getitem__, p)) for p in parts]
        if self.size > self.LIMIT:
            self.old, self.young, self.size = self.young, {}, 0
        return out


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep: Sequence[str] = ("doc_id",),
                     text: str = "text", with_ids: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``keep``, piece, start, length, ids_crc32 (and ids, if asked for)."""
    prepare(docs.sparkSession)
    docs, keep = without_clash(docs, keep, OWN)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), "piece int, start long, length long, ids_crc32 long", *["ids binary"] * with_ids])
    kept, end = len(keep), np.array([END_ID], "<u4").tobytes()

    def run(batches):
        cache = WordCache.of(tokenizer_path)
        cache.LIMIT = cache_bytes
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, piece, start, length, crc, out = [], [], [], [], [], []
                for i, ids in enumerate(cache.ids(part.column(kept).to_pylist())):
                    ids += end
                    for k, p in enumerate(range(0, len(ids), 4 * capacity)):
                        x = ids[p:p + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(p // 4)
                        length.append(len(x) // 4)
                        crc.append(zlib.crc32(x))
                        if with_ids:
                            out.append(x)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i).take(take) for i in range(kept)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *[pa.array(out, pa.binary())] * with_ids],
                    names=[*keep, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return docs.select(*(docs[k] for k in keep), docs[text]).mapInArrow(run, schema)


def best_filling(space: int, lengths: np.ndarray, counts: dict[int, int], branches: int = BRANCHES) -> list[int]:
    """The lengths (the largest first) that fill ``space`` best.

    Depth-first over decreasing lengths with the number of copies of each (the
    longest that fits and most copies first) on a stack of its own, so the
    first leaf is the best-fit filling and serves as the incumbent. A
    branch whose waste can't fall below the incumbent's is cut (no waste is
    the bound that ends the search); a filling that leaves room for a length
    still to be had is dominated by the one that takes it, so only maximal
    fillings are leaves.
    """
    best: list[int] = []
    waste, tried = space, 0
    reach = np.cumsum([int(x) * counts[int(x)] for x in lengths]) if len(lengths) else np.zeros(0)

    def below(left: int, end: int) -> int:
        """The longest of the first ``end`` lengths that fits, or -1."""
        return int(np.searchsorted(lengths[:end], left, side="right")) - 1

    # one entry for each distinct length chosen: its number, its copies, and the space left before it
    chosen: list[list[int]] = []
    left, i = space, below(space, len(lengths))
    while True:
        if i >= 0 and waste and tried < branches:  # down: as many copies as there are and fit
            x = int(lengths[i])
            copies = min(counts[x], left // x)
            tried += 1
            chosen.append([i, copies, left])
            left -= copies * x
            i = below(left, i)
            continue
        if left < waste:
            waste, best = left, [int(lengths[j]) for j, copies, _ in chosen for _ in range(copies)]
        # up: one copy fewer of the shortest length chosen, if what is shorter can then fill more than the incumbent
        i = -1
        while chosen and i < 0 and waste and tried < branches:
            j, copies, before = chosen[-1]
            left = before - (copies - 1) * int(lengths[j])
            if copies > 1:
                chosen[-1][1] -= 1
            else:
                chosen.pop()
            i = below(left, j)
            if i >= 0 and reach[i] < left - waste + 1:
                i = -1
        if i < 0:
            return best


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, branches: int = BRANCHES) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence) and how often each is used."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    plan: list[tuple[list[int], int]] = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        lengths = np.array(sorted(x for x, n in counts.items() if n), np.int64)
        pattern = [top, *best_filling(capacity - top, lengths, counts, branches)]
        counts[top] += 1
        need = pd.Series(pattern).value_counts().to_dict()
        times = min(counts[x] // k for x, k in need.items())
        plan.append((pattern, times))
        for x, k in need.items():
            counts[x] -= k * times
            if not counts[x]:
                del counts[x]
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, branches: int = BRANCHES) -> DataFrame:
    """The pieces with sequence_id and offset; ``pieces`` must be written rows
    (a table or checkpoint), so that its partitions are the same each time."""
    spark = prepare(pieces.sparkSession)
    at = pieces.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    by_part = written(at.groupBy("_part", "length").agg(F.count("*").alias("_n")))
    histogram = {int(r[0]): int(r[1]) for r in by_part.groupBy("length").agg(F.sum("_n")).collect()}
    where = []  # (length, first rank, first sequence, offset), one for each place of a pattern
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan_bins(histogram, capacity, branches):
        offset = 0
        for x in pattern:
            where.append((x, used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    where.sort()
    plan = spark.sparkContext.broadcast(tuple(np.array(c, np.int64) for c in zip(*where, strict=True)) or (np.zeros(0, np.int64),) * 4)

    def place(frames):
        length, rank, first, offset = plan.value
        starts = length * (1 << 44) + rank
        for f in frames:
            k = np.searchsorted(starts, f["length"].to_numpy() * (1 << 44) + f["_rank"].to_numpy(), side="right") - 1
            f["sequence_id"] = first[k] + f["_rank"].to_numpy() - rank[k]
            f["offset"] = offset[k]
            yield f.drop(columns="_rank")

    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_part", "length").orderBy("_row")
    ranked = (at.withColumn("_in", F.row_number().over(inside) - 1).join(starts, ["_part", "length"])
              .select(*(pieces[c] for c in pieces.columns), (F.col("_first") + F.col("_in")).cast("long").alias("_rank")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id long, offset long"])
    return ranked.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep: Sequence[str] = ("doc_id",),
                   text: str = "text", with_ids: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return pack(written(tokenized_pieces(docs, tokenizer_path, capacity, keep, text, with_ids, cache_bytes)), capacity)
