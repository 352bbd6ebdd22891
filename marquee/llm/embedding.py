"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, fitted apart on the first and the second half of the vectors,
form a product grid of cells. Every vector is filed under the cell of its two
nearest codewords. A vector visits cells in the order of the summed distance
of its halves to the cell's codewords (multi-sequence traversal: a heap over
the two sorted lists), until the sum exceeds its smallest one by ``slack``.
``slack`` is set so that a vector at exactly the limit cosine from a sampled
one, in a random direction, lies in a visited cell with the probability
``recall``; closer vectors are found more surely. Each visited cell's vectors
are then compared exactly, in double precision.

A pair counts if either vector visits the other's cell. Each index row knows
which cells its vector visits, so a task sees which of its finds the other
side will not see itself, and counts those for both.

Equal vectors are one class with a multiplicity. Neighbouring words of the first
codebook are put together to bands of about ``BLOCK`` vectors, and a band's cells
are one group, so a vector travels once for all cells of a band that it visits,
as the numbers that it came in. A task compares a block of a band's probes with
a block of its vectors, cell by cell; large bands are cut into blocks on both
sides, so one with a third of all vectors is many tasks. A block gives counts
and a spanning forest of its links, never the pairs.

Vectors of different lengths can't be compared: each length has its own
codebooks, slack, cells and blocks. The sample that fits codebooks and slack of
a length has at most ``SAMPLE`` classes, chosen by a hash of the vector;
codebooks have at most ``MOST_WORDS`` words and grow with the root of the number of
classes until then (some 268 million classes; beyond that cells grow with the
table). The ``MOST_LENGTHS`` commonest lengths have codebooks, so what is broadcast
is bounded; other lengths, and those of at most ``WHOLE`` classes, are one cell,
compared in blocks like any other. Every vector is indexed.

Nulls: vectors that are null, empty, zero, or hold null or non-finite parts
link with nothing. A null id sorts after all others; a component of null ids alone
has a null id. Repeated rows are vectors of their own; ties at the limit cosine
link. Very long vectors are compared whole (a block of at most ``BLOCK_BYTES`` of them is
in memory at once). An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from marquee.llm.common import NO_ID, components, per_batch, prepare, written

LIMIT, RECALL = 0.95, 0.98
SAMPLE, MOST_WORDS, PER_CELL, BLOCK, BLOCK_BYTES, PART = 16_384, 4096, 16, 32_768, 1 << 25, 1024
WHOLE, MOST_LENGTHS = 2048, 64


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1; scaled by their largest part first, so tiny and huge ones don't under- or overflow."""
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :], 0)


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i:i + PART], words).argmin(axis=1) for i in range(0, len(x), PART)])


def codebook(x: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    words = x[rng.choice(len(x), min(size, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, words)
        count = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, x)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return words


def block_rows(d: int) -> int:
    """Vectors of ``d`` parts in a block: ``BLOCK``, or fewer if they are long."""
    return max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, d))))


def n_words(n_classes: int) -> int:
    return int(np.clip(np.sqrt(n_classes / PER_CELL), 1, MOST_WORDS))


class MultiIndex:
    """Codebooks of the two halves, and how far a traversal goes."""

    def __init__(self, sample: np.ndarray, n_classes: int, limit: float, recall: float):
        rng = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        size = n_words(n_classes)
        parts = (sample[:, :self.half], sample[:, self.half:])
        self.words = [codebook(p, size, rng) for p in parts]
        bands = min(size, -(-n_classes // block_rows(sample.shape[1])))
        self.band = nearest(self.words[0], codebook(self.words[0], bands, rng)).astype(np.int64)    # of each first word
        x = sample[:4096]
        away = rng.standard_normal(x.shape)
        away -= (away * x).sum(1)[:, None] * x
        norm = np.sqrt((away * away).sum(1))[:, None]
        y = limit * x + np.sqrt(max(0.0, 1 - limit * limit)) * away / np.maximum(norm, 1e-300)
        excess = []
        for i in range(0, len(x), PART):
            (a, b), (c, d) = self._both(x[i:i + PART]), self._both(y[i:i + PART])
            row = np.arange(len(a))
            excess.append(a[row, c.argmin(1)] + b[row, d.argmin(1)] - a.min(1) - b.min(1))
        excess = np.concatenate(excess)
        self.slack = float(np.quantile(excess, recall)) + 1e-12

    def _both(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, :self.half], self.words[0]), distances(x[:, self.half:], self.words[1])

    def visits(self, x: np.ndarray) -> list[np.ndarray]:
        """Cells of each row in the order of the traversal; the first is its own."""
        if len(x) > PART:
            return [cells for i in range(0, len(x), PART) for cells in self.visits(x[i:i + PART])]
        a, b = self._both(x)
        first, second = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        width = len(self.words[1])
        out = []
        for i in range(len(x)):
            p, q = a[i][first[i]], b[i][second[i]]
            limit = p[0] + q[0] + self.slack
            heap, cells = [(p[0] + q[0], 0, 0)], []
            while heap:
                s, j, k = heapq.heappop(heap)
                if s > limit:
                    break
                cells.append(int(first[i, j]) * width + int(second[i, k]))
                if k + 1 < len(q):
                    heapq.heappush(heap, (p[j] + q[k + 1], j, k + 1))
                if not k and j + 1 < len(p):  # each cell is offered once: by its row's first
                    heapq.heappush(heap, (p[j + 1] + q[0], j + 1, 0))
            out.append(np.array(cells, "<i4"))
        return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each probe (row) and vector (column) of a block: the column that stands for its component, or -1."""
    n = linked.shape[1]
    column = np.where(linked.any(axis=0), np.arange(n), n)
    while True:
        row = np.where(linked, column[None, :], n).min(axis=1, initial=n)
        new = np.minimum(column, np.where(linked, row[:, None], n).min(axis=0, initial=n))
        if (new == column).all():
            return np.where(row < n, row, -1), np.where(column < n, column, -1)
        column = new


def _numbers(blobs: list[bytes], wide: bool) -> np.ndarray:
    return unit(np.frombuffer(b"".join(blobs), "<f8" if wide else "<f4").reshape(len(blobs), -1))


def _compare(limit: float, wide: bool):
    """Compares the blocks of a task, cell by cell."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        keys, adds, roots = [], [], []
        for _, block in f.groupby(["d", "band", "ib", "pb"], sort=False):
            p, q = (block[block["probe"] == side] for side in (True, False))
            if not len(p) or not len(q):
                continue
            x, y = (_numbers(side["v"].tolist(), wide) for side in (p, q))
            key, copies, own = (q[c].to_numpy() for c in ("c", "k", "own"))
            key_p, copies_p, own_p = (p[c].to_numpy() for c in ("c", "k", "own"))
            cells = [np.frombuffer(b, "<i4") for b in p["cells"]]
            cell = np.concatenate(cells)
            probe = np.repeat(np.arange(len(p)), [len(c) for c in cells])
            order = np.argsort(cell, kind="stable")
            cell, probe = cell[order], probe[order]
            visits = q["cells"].to_numpy()
            by_cell = np.argsort(own, kind="stable")
            for at in np.split(by_cell, np.flatnonzero(np.diff(own[by_cell])) + 1):
                here = own[at[0]]
                asked = probe[np.searchsorted(cell, here):np.searchsorted(cell, here, side="right")]
                for i in range(0, len(asked), PART):
                    r = asked[i:i + PART]
                    linked = x[r] @ y[at].T >= limit
                    linked &= key_p[r][:, None] != key[at][None, :]
                    if not linked.any():
                        continue
                    keys.append(key_p[r])
                    adds.append(linked @ copies[at])
                    # finds that the vector itself won't make, as it doesn't visit the probe's cell
                    unseen = np.zeros(linked.shape, bool)
                    for j in np.flatnonzero(linked.any(axis=0)):
                        other = np.flatnonzero(linked[:, j] & (own_p[r] != here))
                        if len(other):
                            unseen[other, j] = ~np.isin(own_p[r][other], np.frombuffer(visits[at[j]], "<i4"))
                    keys.append(key[at])
                    adds.append(copies_p[r] @ unseen)
                    row, column = forest(linked)
                    roots += [np.where(t >= 0, key[at][t], k) for t, k in ((row, key_p[r]), (column, key[at]))]
        if not keys:
            return pd.DataFrame({"c": [], "links": [], "root": []}).astype("int64")
        out = pd.DataFrame({"c": np.concatenate(keys), "links": np.concatenate(adds), "root": np.concatenate(roots)})
        return out[(out["links"] > 0) | (out["root"] != out["c"])].astype("int64")
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """id, n_links, component_id, kept of each vector."""
    spark = prepare(vectors.sparkSession)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = vectors.schema[vector].dataType.elementType != FloatType()
    part = "double" if wide else "float"
    v = vectors.select(F.coalesce(vectors[id_col], F.lit(NO_ID)).cast("long").alias("id"), vectors[vector].cast(f"array<{part}>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    v = v.withColumn("v", F.when(fine, F.col("v")))
    v = v.withColumn("c", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    classes = written(v.where("c is not null").groupBy("c").agg(F.first("v").alias("v"), F.count("*").alias("k"), F.min("id").alias("id")))
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).where(F.col("n") > WHOLE)
    index = {}
    for d, n in map(tuple, lengths.orderBy(F.col("n").desc(), "d").limit(MOST_LENGTHS).collect()):
        sample = classes.where(F.size("v") == d).select("c", "v").orderBy(F.xxhash64("c", F.lit(1)), "c").limit(SAMPLE).select("v").toArrow()["v"]
        index[d] = MultiIndex(unit(sample.combine_chunks().flatten().to_numpy().reshape(-1, d)), n, limit, recall)
    shared = spark.sparkContext.broadcast(index)

    def code(batch: pa.RecordBatch):
        sizes = pc.list_value_length(batch.column("v")).to_numpy()
        for d in np.unique(sizes).tolist():
            some = batch.filter(pa.array(sizes == d))
            raw = some.column("v").flatten().to_numpy().reshape(some.num_rows, d)
            own = shared.value.get(d)
            cells = own.visits(unit(raw)) if own else [np.zeros(1, "<i4")] * len(raw)
            band = own.band if own else np.zeros(1, np.int64)
            words = len(own.words[1]) if own else 1
            bands = [band[c // words] for c in cells]
            rows = [np.unique(b) for b in bands]
            at = np.repeat(np.arange(len(raw)), [len(r) for r in rows])
            row = np.concatenate(rows)
            blob = [r.astype("<f8" if wide else "<f4").tobytes() for r in raw]
            first = np.array([c[0] for c in cells])
            # a probe carries the cells of this band that it visits, a vector in its own band all that it visits
            inside = [cells[i][bands[i] == r].tobytes() for i, r in zip(at, row, strict=True)]
            for who, place, which, probe in ((at, row, inside, True), (np.arange(len(raw)), band[first // words], [c.tobytes() for c in cells], False)):
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays([some.column("c").take(take), some.column("k").take(take), pa.array(np.full(len(who), d), pa.int32()),
                                                  pa.array([blob[i] for i in who], pa.binary()), pa.array(first[who], pa.int32()), pa.array(which, pa.binary()),
                                                  pa.array(place, pa.int32()), pa.array(np.full(len(who), probe))],
                                                 names=["c", "k", "d", "v", "own", "cells", "band", "probe"])

    coded = written(per_batch(classes.select("c", "k", "v"), code, "c long, k long, d int, v binary, own int, cells binary, band int, probe boolean"))
    # blocks of probes and of vectors of the bands that have several: fewer rows than there are blocks, so the
    # broadcast has a proven bound, and no vector travels to learn its blocks
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest(F.col("d"), F.lit(1))))))
    sizes = (coded.groupBy("d", "band").agg(F.count_if("probe").alias("np"), F.count_if(~F.col("probe")).alias("ni")).where("ni > 0")
             .select("d", "band", F.ceil(F.col("ni") / most).cast("int").alias("nib"), F.ceil(F.col("np") / most).cast("int").alias("npb"))
             .where("nib > 1 or npb > 1"))
    both = coded.join(F.broadcast(sizes), ["d", "band"], "left").withColumns({n: F.coalesce(n, F.lit(1)) for n in ("nib", "npb")})
    block = lambda n, salt: F.pmod(F.xxhash64("c", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = (both.withColumn("ib", F.explode(F.when(F.col("probe"), every("nib")).otherwise(F.array(block("nib", 2)))))
             .withColumn("pb", F.explode(F.when(F.col("probe"), F.array(block("npb", 3))).otherwise(every("npb"))))
             .withColumn("g", F.pmod(F.xxhash64("d", "band", "ib", "pb"), F.lit(8 * width)))
             .select("g", "d", "band", "ib", "pb", "probe", "c", "k", "v", "own", "cells"))
    found = written(dealt.groupBy("g").applyInPandas(_compare(limit, wide), "c long, links long, root long"))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    root = components(found.select("c", "root"), "c", "root").withColumnRenamed("node", "c")
    grouped = classes.select("c", "k", "id").join(root, "c", "left").withColumn("root", F.coalesce("root", "c")).join(links, "c", "left")
    least = grouped.groupBy("root").agg(F.min("id").alias("component"))
    of_class = grouped.join(least, "root").select("c", (F.coalesce("links", F.lit(0)) + F.col("k") - 1).alias("n_links"), "component")
    out = v.select("id", "c").join(of_class, "c", "left").withColumn("component", F.coalesce("component", "id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("id").alias("id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), real("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))
