"""Similarity join on word shingles by vertical partitioning.

The shingles of all candidate documents have one global order, the rarest
first. Cut points split that order into fragments, every document into one
segment a fragment. Overlaps of a pair are counted fragment by fragment, each
by a task of its own, and summed by pair; the sum decides exactly.

Which pairs are counted:

1. *Documents that can't link.* A linked document shares 75 % of its shingles
   at least, so one with more than 25 % of shingles that no other document
   holds is out. A fixed half of all shingle values is enough to see that for
   nearly all documents; the others stay candidates, so nothing is lost.
2. *Classes.* Candidates with the same words are one class from here on.
3. *Prefixes.* In the global order a linked pair shares one of the first
   n - ceil(0.75 n) + 1 shingles of both. Documents with a prefix shingle in
   common could be all pairs of a large group; instead each is paired with
   the group's most central member first. After those links are merged, only
   members of one shingle's group that are still in different components, one
   of them outside the group's largest component, are paired. Pairs inside a
   component need no count: they can't change the result. A member's place in
   its own order bounds the size of a partner whose first common shingle this
   is (what comes before is not in the partner), and the smaller one of a pair
   must reach its own size at least: so a group splits into early members and
   late ones, which never pair among themselves, and only early ones are
   paired, with members of a size that both places allow. Documents that are
   one template with own filler are late in the template's groups. Then the
   numbers of both members' shingles in ``CELLS`` hash cells bound the overlap
   (the sum of the smaller ones); near copies that lost different shingles fall
   below the limit there.

Counting goes through packed messages: a chunk of documents asks about each of
its shingles once, whatever the number of its documents that hold it, so a
shingle that a third of all documents hold costs one value a chunk.

Shingles are compared as 64-bit hashes. Nulls and texts without words have an
empty set, link with nothing and are their own component. A null id sorts
after all others; a component of null ids alone has a null id. Rows that share
an id and a text are copies of each other; rows that share an id only are
documents of their own. Very long texts are read whole; an empty table gives
no rows; other columns are left out. Ties between members go to the smallest
id, then to the smallest hash of id and text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import NO_ID, Memo, chunk_id, components, mix, per_batch, prepare, written

WORDS, PERCENT, FRAGMENTS, CELLS = 5, 75, 8, 128
CHUNK_ROWS, CHUNK_SHINGLES = 1024, 1_000_000
STAT = "key long, id long, n long, single long, sig binary"


class Shingles:
    """Sorted distinct shingle hashes of a text, and a signature of its words."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.memo = Memo(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> tuple[np.ndarray, bytes]:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64), b""
        h = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        n = len(words) - size + 1
        s = np.full(n, size, np.uint64)
        for k in range(size):
            s = mix(s + h[k:k + n])
        return np.unique(s), xxhash.xxh3_128_digest(b" ".join(words))


def chunks(rows, key=lambda r: r):
    """Lists of rows of bounded size, in order; key(row) has a row's shingles."""
    own, size = [], 0
    for r in rows:
        own.append(r)
        size += len(key(r))
        if len(own) >= CHUNK_ROWS or size >= CHUNK_SHINGLES:
            yield own
            own, size = [], 0
    if own:
        yield own


def _questions(tokens: np.ndarray, doc: np.ndarray, buckets: int):
    """Splits a chunk's shingles: those of one document only (with it) and those of several (once), by bucket."""
    uniq, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
    several = count > 1
    here = several[inverse]
    own, own_doc = tokens[~here], doc[~here]
    place = lambda t: ((t >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    return uniq[several], count[several], here, own, own_doc, place


def _ask_half(buckets: int):
    """Messages that find each document's shingles that no other one holds."""
    def run(batches):
        shingles, number = Shingles(), 0
        for batch in batches:
            for own in chunks(_rows(batch, shingles), lambda r: r[2]):
                yield _half_messages(own, buckets, number)
                number += 1
    return run


def _rows(batch, shingles):
    for k, i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield k, i, *shingles(t.as_py())


def _half_messages(rows: list, buckets: int, number: int) -> pa.RecordBatch:
    n = len(rows)
    sets = [r[2][(r[2] & np.uint64(1)) == 0] for r in rows]
    tokens = np.concatenate(sets)
    doc = np.repeat(np.arange(n, dtype=np.uint16), [len(s) for s in sets])
    shared, _, here, own, own_doc, place = _questions(tokens, doc, buckets)
    local = np.bincount(doc[here], minlength=n)
    keys = np.array([r[0] for r in rows], "<i8")
    chunk = chunk_id(number, keys.tobytes())
    home = b"".join([keys.tobytes(), np.array([r[1] for r in rows], "<i8").tobytes(), np.array([len(r[2]) for r in rows], "<i8").tobytes(),
                     np.array([len(s) - x for s, x in zip(sets, local, strict=True)], "<i8").tobytes(), b"".join(r[3].ljust(16, b"\0") for r in rows)])
    b_own, b_shared = place(own), place(shared)
    o, s = np.argsort(b_own, kind="stable"), np.argsort(b_shared, kind="stable")
    e_own, e_shared = np.searchsorted(b_own[o], np.arange(buckets + 1)), np.searchsorted(b_shared[s], np.arange(buckets + 1))
    own, own_doc, shared = own[o], own_doc[o], shared[s]
    used = np.union1d(np.union1d(b_own, b_shared), [chunk % buckets]).astype(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int64()),
        pa.array([own[e_own[b]:e_own[b + 1]].tobytes() for b in used], pa.binary()), pa.array([own_doc[e_own[b]:e_own[b + 1]].tobytes() for b in used], pa.binary()),
        pa.array([shared[e_shared[b]:e_shared[b + 1]].tobytes() for b in used], pa.binary()), pa.array([home if b == chunk % buckets else None for b in used], pa.binary())],
        names=["bucket", "chunk", "own", "doc", "shared", "home"])


def _joined(parts, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of some binaries, and where each binary's values start."""
    size = np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(parts), dtype), np.cumsum([0, *(len(p) // size for p in parts)])


def _answer_half(f: pd.DataFrame) -> pd.DataFrame:
    own, at = _joined(f["own"], "<u8")
    doc, _ = _joined(f["doc"], "<u2")
    shared, _ = _joined(f["shared"], "<u8")
    _, inverse, count = np.unique(np.concatenate([own, shared]), return_inverse=True, return_counts=True)
    again = count[inverse[:len(own)]] > 1
    found = [np.bincount(doc[a:b][again[a:b]]).astype("<i4").tobytes() if a < b else b"" for a, b in zip(at[:-1], at[1:], strict=True)]
    return pd.DataFrame({"chunk": f["chunk"], "found": found, "home": f["home"]})


def _sum_half(f: pd.DataFrame) -> pd.DataFrame:
    home = next(h for h in f["home"] if h is not None)
    n = len(home) // 48
    key, id_, size, single = (np.frombuffer(home, "<i8", n, 8 * n * k) for k in range(4))
    single = single.copy()
    for x in f["found"]:
        x = np.frombuffer(x, "<i4")
        single[:len(x)] -= x
    return pd.DataFrame({"key": key, "id": id_, "n": size, "single": single, "sig": [home[32 * n + 16 * i:32 * n + 16 * i + 16] for i in range(n)]})


def _pack_classes(batches):
    """One row a chunk of classes: their keys, sizes and shingles."""
    shingles, number = Shingles(), 0
    for batch in batches:
        rows = ((k, shingles(t.as_py())[0]) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
        for own in chunks(rows, lambda r: r[1]):
            keys = np.array([r[0] for r in own], "<i8").tobytes()
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([chunk_id(number, keys)], pa.int64()), pa.array([keys], pa.binary()),
                                              pa.array([np.array([len(r[1]) for r in own], "<i8").tobytes()], pa.binary()),
                                              pa.array([np.concatenate([r[1] for r in own]).tobytes()], pa.binary())], names=["chunk", "keys", "sizes", "tokens"])


def _by_bucket(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct shingles sorted by bucket, their counts, the bucket ends, and each shingle's place among them."""
    uniq, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
    bucket = ((uniq >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(uniq), np.int64)
    place[order] = np.arange(len(uniq))
    return uniq[order], count[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), place[inverse]


def _ask_counts(buckets: int):
    def run(batch: pa.RecordBatch):
        for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
            uniq, count, ends, _ = _by_bucket(np.frombuffer(blob, "<u8"), buckets)
            used = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int64()),
                                              pa.array([uniq[ends[b]:ends[b + 1]].tobytes() for b in used], pa.binary()),
                                              pa.array([count[ends[b]:ends[b + 1]].astype("<u4").tobytes() for b in used], pa.binary())], names=["bucket", "chunk", "tokens", "counts"])
    return run


def _answer_counts(f: pd.DataFrame) -> pd.DataFrame:
    tokens, at = _joined(f["tokens"], "<u8")
    counts, _ = _joined(f["counts"], "<u4")
    _, inverse = np.unique(tokens, return_inverse=True)
    df = np.bincount(inverse, weights=counts)[inverse].astype("<i8")
    return pd.DataFrame({"chunk": f["chunk"], "bucket": f["bucket"], "df": [df[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]})


def _order(buckets: int):
    """Each class's shared shingles in the global order: by document frequency, then by hash."""
    def run(state: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {k: [] for k in ("c", "n", "m", "tokens", "df")}
        if len(state):
            keys, sizes, tokens = np.frombuffer(state["keys"][0], "<i8"), np.frombuffer(state["sizes"][0], "<i8"), np.frombuffer(state["tokens"][0], "<u8")
            _, _, _, place = _by_bucket(tokens, buckets)
            df = np.frombuffer(b"".join(replies.sort_values("bucket")["df"]), "<i8")[place]
            ends = np.cumsum([0, *sizes])
            for c, n, a, b in zip(keys, sizes, ends[:-1], ends[1:], strict=True):
                many = df[a:b] > 1
                t, d = tokens[a:b][many], df[a:b][many]
                if 100 * len(t) < PERCENT * n:
                    continue
                o = np.argsort(d, kind="stable")  # shingles are sorted by hash already
                for k, v in zip(out, (c, n, len(t), t[o].tobytes(), d[o].tobytes()), strict=True):
                    out[k].append(v)
        return pd.DataFrame(out)
    return run


def order_key(df: np.ndarray, token: np.ndarray) -> np.ndarray:
    """A number that follows the global order, up to hash bits beyond the 40th."""
    return (np.minimum(df, (1 << 22) - 1) << 40) | (token >> np.uint64(24)).astype(np.int64)


def _segments(batch: pa.RecordBatch, cuts: np.ndarray):
    """(row of the batch, fragment, segment) of every class that has shingles in the fragment."""
    row, part, blob = [], [], []
    for i, (t, d) in enumerate(zip(batch.column("tokens").to_pylist(), batch.column("df").to_pylist(), strict=True)):
        t, d = np.frombuffer(t, "<u8"), np.frombuffer(d, "<i8")
        ends = np.concatenate([[0], np.searchsorted(order_key(d, t), cuts), [len(t)]])
        for f in np.flatnonzero(np.diff(ends)):
            row.append(i)
            part.append(f)
            blob.append(t[ends[f]:ends[f + 1]].tobytes())
    return row, part, blob


def _profiles(batch: pa.RecordBatch):
    """(class, its shared shingles in each hash cell)."""
    counts = [np.bincount((np.frombuffer(t, "<u8") >> np.uint64(8)).astype(np.int64) % CELLS, minlength=CELLS).astype(np.int32) for t in batch.column("tokens").to_pylist()]
    cells = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * CELLS, pa.int32()), pa.array(np.concatenate(counts)))
    yield pa.RecordBatch.from_arrays([batch.column("c"), cells], names=["c", "cells"])


def _may_link(nx, mx, ny, my):
    """Can two classes with n shingles, m of them in other classes too, reach the limit?"""
    most = F.least(mx, my)
    return 100 * most >= PERCENT * (nx + ny - most)


class Join:
    """The candidates' classes in global order, and exact counts of pairs."""

    def __init__(self, ordered: DataFrame):
        self.ordered = ordered
        sample = per_batch(ordered.select("tokens", "df"), _sample_keys, "k long")
        quantiles = [(i + 1) / FRAGMENTS for i in range(FRAGMENTS - 1)]
        cuts = sample.agg(F.percentile_approx("k", quantiles)).first()[0]
        self.cuts = np.array(sorted(cuts or []), np.int64)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (x, y) that reach the limit; overlaps are counted by fragment and summed."""
        cuts = self.cuts
        wanted = pairs.groupBy("x").agg(F.collect_set("y").alias("ys"))
        left = self.ordered.join(wanted, F.col("c") == F.col("x")).select("c", "n", "tokens", "df", "ys")
        right = self.ordered.join(pairs.select("y").distinct(), F.col("c") == F.col("y"), "left_semi").select("c", "n", "tokens", "df")

        def deal(batch: pa.RecordBatch):
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                _, part, blob = _segments(one, cuts)
                ys = np.array(one.column("ys")[0].as_py(), np.int64)
                x, n = one.column("c")[0].as_py(), one.column("n")[0].as_py()
                for at in range(0, len(ys), 256):
                    y = ys[at:at + 256]
                    size = len(y) * len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(y, len(part))), pa.array(np.tile(part, len(y)).astype(np.int32)), pa.array(np.full(size, x)), pa.array(np.full(size, n)),
                                                      pa.array(blob * len(y), pa.binary())], names=["y", "f", "x", "nx", "sx"])

        def cut(batch: pa.RecordBatch):
            row, part, blob = _segments(batch, cuts)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("c").take(take), pa.array(part, pa.int32()), batch.column("n").take(take), pa.array(blob, pa.binary())], names=["y", "f", "ny", "sy"])

        def overlap(batch: pa.RecordBatch):
            sx, sy = batch.column("sx"), batch.column("sy")
            n = [len(np.intersect1d(np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8"), assume_unique=True)) for a, b in zip(sx, sy, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("x", "y", "nx", "ny")), pa.array(n, pa.int64())], names=["x", "y", "nx", "ny", "o"])

        parts = per_batch(left, deal, "y long, f int, x long, nx long, sx binary").join(per_batch(right, cut, "y long, f int, ny long, sy binary"), ["y", "f"])
        counted = per_batch(parts.select("x", "y", "nx", "ny", "sx", "sy"), overlap, "x long, y long, nx long, ny long, o long")
        return (counted.groupBy("x", "y", "nx", "ny").agg(F.sum("o").alias("o"))
                .where(100 * F.col("o") >= PERCENT * (F.col("nx") + F.col("ny") - F.col("o"))).select("x", "y"))


def _sample_keys(batch: pa.RecordBatch):
    t, _ = _joined(batch.column(0).to_pylist(), "<u8")
    d, _ = _joined(batch.column(1).to_pylist(), "<i8")
    some = (t & np.uint64(63)) == 0  # enough to place the cuts; counts use all
    yield pa.RecordBatch.from_arrays([pa.array(order_key(d[some], t[some]))], names=["k"])


def _prefixes(batch: pa.RecordBatch):
    """(shingle, class, n, m, most) of the shared shingles within each class's
    prefix; most: the largest partner whose first common shingle this can be."""
    token, row, most = [], [], []
    n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
    for i, t in enumerate(batch.column("tokens").to_pylist()):
        length = n[i] - -(-PERCENT * n[i] // 100) + 1 - (n[i] - m[i])  # shingles of this class alone come first
        if length > 0:
            t = np.frombuffer(t, "<i8", min(length, m[i]))
            token.append(t)
            row.append(np.full(len(t), i))
            # at most n - place are common, and the limit asks for PERCENT / (100 + PERCENT) of both sizes
            left = m[i] - np.arange(len(t))
            most.append(((100 + PERCENT) * left - PERCENT * n[i]) // PERCENT)
    if token:
        take = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), *(batch.column(c).take(take) for c in ("c", "n", "m")), pa.array(np.concatenate(most), pa.int64())],
                                         names=["t", "c", "n", "m", "most"])


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, key, n_shingles, component_id, kept of each document; key: xxhash64 of
    id and text; kept: true for one of each component's (id, key)."""
    spark = prepare(docs.sparkSession)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.xxhash64(docs[id_col], docs[text]).alias("key"), F.coalesce(docs[id_col], F.lit(NO_ID)).cast("long").alias("id"), docs[text].alias("text"))
    messages = source.mapInArrow(_ask_half(buckets), "bucket int, chunk long, own binary, doc binary, shared binary, home binary")
    replies = messages.groupBy("bucket").applyInPandas(_answer_half, "chunk long, found binary, home binary")
    stat = written(replies.groupBy("chunk").applyInPandas(_sum_half, STAT))

    able = stat.where((F.col("n") > 0) & (100 * F.col("single") <= (100 - PERCENT) * F.col("n")))
    classes = written(able.groupBy("sig").agg(F.min(F.struct("id", "key")).alias("m")).select("sig", F.col("m.id").alias("id"), F.col("m.key").alias("c")))
    texts = (source.select("key", "text").join(classes.select(F.col("c").alias("key")), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))
    state = written(texts.mapInArrow(_pack_classes, "chunk long, keys binary, sizes binary, tokens binary"))
    counts = (per_batch(state, _ask_counts(buckets), "bucket int, chunk long, tokens binary, counts binary")
              .groupBy("bucket").applyInPandas(_answer_counts, "chunk long, bucket int, df binary"))
    ordered = written(state.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInPandas(_order(buckets), "c long, n long, m long, tokens binary, df binary"))

    join = Join(ordered)
    prefix = written(per_batch(ordered.select("c", "n", "m", "tokens"), _prefixes, "t long, c long, n long, m long, most long"))
    lone = (F.col("n") - F.col("m")) * 1_000_000 / F.col("n")
    centre = (prefix.withColumn("lone", lone).groupBy("t").agg(F.min(F.struct("lone", "c", "n", "m")).alias("p"), F.count("*").alias("k")).where("k > 1").select("t", "p"))
    star = (prefix.join(centre, "t").where((F.col("c") != F.col("p.c")) & _may_link(F.col("n"), F.col("m"), F.col("p.n"), F.col("p.m")))
            .select(F.col("c").alias("x"), F.col("p.c").alias("y")).distinct())
    star = written(star)
    links = written(join.links(star))

    root = components(links, "x", "y").withColumnRenamed("node", "c")
    placed = written(prefix.join(root, "c", "left").withColumn("root", F.coalesce("root", "c")))
    by_root = placed.groupBy("t", "root").agg(F.count("*").alias("k"))
    main = (by_root.groupBy("t").agg(F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
            .select("t", F.col("top.root").alias("main")))
    mixed = written(placed.join(main, "t"))
    profiles = per_batch(join.ordered.select("c", "tokens").join(mixed.select("c").distinct(), "c", "left_semi"), _profiles, "c long, cells array<int>")
    mixed = mixed.join(profiles, "c")
    side = lambda df, k: df.select("t", *(F.col(c).alias(f"{c}{k}") for c in ("c", "n", "m", "most", "root", "main", "cells")))
    shared = F.aggregate(F.zip_with("cells1", "cells2", lambda a, b: F.least(a, b)), F.lit(0), lambda a, x: a + x)
    smaller = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("c1") < F.col("c2")))
    able = (smaller & (F.col("n2") <= F.col("most1")) & (F.col("n1") <= F.col("most2")) & (F.col("root1") != F.col("root2"))
            & _may_link(F.col("n1"), F.col("m1"), F.col("n2"), F.col("m2")) & (100 * shared >= PERCENT * (F.col("n1") + F.col("n2") - shared)))
    early, minor = mixed.where("most >= n"), F.col("root") != F.col("main")
    # one of a pair is outside the group's largest component: the smaller one, or only the larger one
    pairs = (side(early.where(minor), 1).join(side(mixed, 2), "t").where(able)
             .unionByName(side(early.where(~minor), 1).join(side(mixed.where(minor), 2), "t").where(able)))
    rest = pairs.select(F.least("c1", "c2").alias("x"), F.greatest("c1", "c2").alias("y")).distinct()
    rest = rest.join(star.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), ["x", "y"], "left_anti")
    more = written(join.links(written(rest)))

    root = components(links.unionByName(more), "x", "y").withColumnRenamed("node", "c")
    grouped = classes.join(root, "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = grouped.groupBy("root").agg(F.min(F.struct("id", "c")).alias("first"))
    of_sig = grouped.join(least, "root").select("sig", F.col("first.id").alias("component"), F.col("first.c").alias("first"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return (stat.join(of_sig, "sig", "left").withColumn("component", F.coalesce("component", "id"))
            .select(real("id").alias("id"), "key", F.col("n").alias("n_shingles"), real("component").alias("component_id"),
                    F.coalesce(F.col("key") == F.col("first"), F.lit(True)).alias("kept")))
