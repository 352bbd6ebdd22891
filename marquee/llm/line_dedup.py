"""Removal of repeated passages of lines.

Every three consecutive lines of a document are a window. Windows that occur
more than once anywhere are found by their 128-bit hash; the occurrence with
the smallest (doc_id, line number) stays, and the lines that any later
occurrence covers go. Windows overlap, so a repeated passage of n lines is
n - 2 repeated windows whose covered positions merge into one run.

Counting windows is pre-aggregated where they are read, so a window that a
third of the corpus holds costs one row a partition; the join that finds its
later occurrences is a plain equi-join that adaptive execution may split.

Lines are what ``\\n`` separates, compared as they are. Documents of fewer
than three lines have no window; windows of three empty lines don't count.
Nulls: null texts have no line and stay null; a null id sorts after all
others. Rows that share an id and a text are the same document: all stay or
lose the same lines. Very long texts are read whole. An empty table gives no
rows; other columns pass through unless their names are this operator's. Ties,
occurrences at the same id and line, are the same document's and all stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import NO_ID, mix, per_batch, prepare, written

WINDOW = 3


def window_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes and the first line of each window."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n") if text else []
    n = len(lines) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    full = np.fromiter((len(x) > 0 for x in lines), bool, len(lines))
    out = []
    for seed in (0, 1):
        h = np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in lines), np.uint64, len(lines))
        w = h[:n]
        for k in range(1, WINDOW):
            w = mix(w) + h[k:k + n]
        out.append(mix(w).view(np.int64))
    some = np.logical_or.reduce([full[k:k + n] for k in range(WINDOW)])
    return out[0][some], out[1][some], np.flatnonzero(some).astype(np.int32)


def _windows(batch: pa.RecordBatch):
    ids, keys, texts = (batch.column(i) for i in range(3))
    for at in range(0, batch.num_rows, 1024):
        found = [window_hashes(t) for t in texts.slice(at, 1024).to_pylist()]
        take = pa.array(np.repeat(np.arange(at, at + len(found)), [len(f[0]) for f in found]))
        if len(take):
            yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), *(pa.array(np.concatenate([f[k] for f in found])) for k in range(3))],
                                             names=["id", "key", "h1", "h2", "line"])


def without_lines(text: str, first: list[int]) -> tuple[str, int]:
    """The text without the lines that windows starting at ``first`` cover, and their number."""
    lines = text.split("\n")
    gone = {i + k for i in first for k in range(WINDOW)}
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and n_lines, n_removed (long)."""
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (id_col, text, "n_lines", "n_removed")]
    keyed = docs.select(F.coalesce(docs[id_col], F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64(docs[text]).alias("key"), docs[text].alias("text"))
    windows = per_batch(keyed, _windows, "id long, key long, h1 long, h2 long, line int")
    repeated = (windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("id", "line")).alias("first"))
                .where("n > 1").select("h1", "h2", "first"))
    later = (windows.join(repeated, ["h1", "h2"]).where(F.struct("id", "line") > F.col("first"))
             .groupBy("id", "key").agg(F.collect_set("line").alias("lines")))
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    named = docs.select(F.coalesce(docs[id_col], F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64(docs[text]).alias("key"), docs[id_col].alias("_id"),
                        docs[text].alias("_text"), *(docs[c].alias(f"_c{i}") for i, c in enumerate(rest)))
    joined = named.join(later, ["id", "key"], "left").select("_id", "_text", "lines", *(f"_c{i}" for i in range(len(rest))))

    def apply(batch: pa.RecordBatch):
        texts, n_lines, removed = [], [], []
        for t, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            n_lines.append(t.count("\n") + 1 if t is not None else 0)
            t, gone = without_lines(t, first) if first else (t, 0)
            texts.append(t)
            removed.append(gone)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *(batch.column(3 + i) for i in range(len(rest))),
                                          pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64())],
                                         names=[id_col, text, *rest, "n_lines", "n_removed"])

    q = lambda c: "`" + c.replace("`", "``") + "`"
    schema = ", ".join([f"{q(id_col)} {types[id_col]}", f"{q(text)} string", *(f"{q(c)} {types[c]}" for c in rest), "n_lines long", "n_removed long"])
    return per_batch(joined, apply, schema)


#: The same by SQL: one row a document, the kept text as its digest.
SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS k
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)
      WHERE ls[i] <> '' OR ls[i + 1] <> '' OR ls[i + 2] <> ''),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nr FROM w),
g AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS line FROM r WHERE nr > 1),
l AS (SELECT doc_id, line, t FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS t FROM d)),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
             string_agg(l.t, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL) AS kept
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, md5(coalesce(kept, '')) AS kept_md5 FROM k
"""
