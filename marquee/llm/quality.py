"""Quality rules with the frequency of lines across documents.

Each document gets its base figures where it is read. Its lines, normalised
(A-Z lower-cased, white space to one space) and hashed, are counted over all
documents of its host: a line that at least ``min_docs`` documents and more
than ``share`` of the host's documents hold is above the limits and goes. A
document that is left with fewer than ``min_words`` words, or with less than
``min_left`` of its words, is depleted and rejected.

A document adds one row for each of its distinct lines, and counts are summed
before the shuffle, so neither a hot host nor a line that all of its documents
hold meets in one task. Line hashes have 64 bits: a chance meeting of two
lines moves a count by one.

Nulls: a null text has no words, so it fails the base rules; documents with a
null host share one. Every row is a document of its own, repeated rows too.
Very long texts are read whole; an empty table gives no rows; columns other
than ``keep`` are left out; a kept one named like a result gets ``_kept`` after
its name. Ties don't arise: limits are on counts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import MUL1, mix, per_batch, prepare, without_clash, written

MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
MIN_DOCS, SHARE, MIN_LEFT = 10, 0.01, 0.5
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = h[:n].copy()
    for k in range(1, window):
        w *= MUL1
        w += h[k:k + n]
    w = mix(w)
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def line_key(line: bytes) -> tuple[int, int]:
    """Hash of the normalised line and its number of words."""
    words = line.lower().split()
    return xxhash.xxh3_64_intdigest(b" ".join(words)), len(words)


def base_figures(text: str | None) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words under each line's hash."""
    if not text:
        return 0, 0, 0, 0, 0, {}
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup, lines = 0, {}
    for line in raw.split(b"\n"):
        key, n = line_key(line)
        if not n:
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        lines[key] = lines.get(key, 0) + n
    return len(words), len(text) - spaces, symbols, dup, repeated_words(words), lines


def _figures(batch: pa.RecordBatch):
    n = batch.num_columns - 1
    for at in range(0, batch.num_rows, 1024):
        part = batch.slice(at, 1024)
        rows = [base_figures(t) for t in part.column(n).to_pylist()]
        ends = np.cumsum([0, *(len(r[5]) for r in rows)])
        keys = np.fromiter((k for r in rows for k in r[5]), np.uint64, ends[-1]).view(np.int64)
        size = np.fromiter((v for r in rows for v in r[5].values()), np.int32, ends[-1])
        lines = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(keys), pa.array(size)], ["h", "w"]))
        yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n)), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(5)), lines],
                                         names=[*part.schema.names[:n], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])


#: Names of the result's columns and of those on the way to it.
OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words", "base_failed", "kept", "clean_text",
       "lines", "_host", "_text", "_in", "_row", "_gone")


def quality_rules(docs: DataFrame, keep: Sequence[str] = ("doc_id",), host: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
                  share: float = SHARE, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT, with_text: bool = False) -> DataFrame:
    """``keep``, the base figures, n_common_words (in removed lines), base_failed, kept; with ``with_text`` also
    clean_text: the text less the removed lines."""
    prepare(docs.sparkSession)
    docs, keep = without_clash(docs, keep, OWN)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    more = ["_text"] * with_text
    source = docs.select(*(docs[k] for k in keep), F.coalesce(docs[host].cast("string"), F.lit("\0")).alias("_host"),
                         *(docs[text].alias(m) for m in more), docs[text].alias("_in"))
    figures = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h:long,w:int>>"
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), "_host string", *(f"{m} string" for m in more), figures])
    seen = written(per_batch(source, _figures, schema)).withColumn("_row", F.monotonically_increasing_id())
    lines = seen.select("_row", "_host", F.explode("lines").alias("l")).select("_row", "_host", "l.h", "l.w")
    hosts = seen.groupBy("_host").agg(F.count("*").alias("docs"))
    common = (lines.groupBy("_host", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
              .join(hosts, "_host").where(F.col("n") > share * F.col("docs")).select("_host", "h"))
    gone = (lines.join(common, ["_host", "h"], "left_semi").groupBy("_row")
            .agg(F.sum("w").alias("n_common_words"), *[F.collect_set("h").alias("_gone")] * with_text))
    left = F.col("n_words") - F.col("n_common_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = (seen.drop("lines").join(gone, "_row", "left").withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
           .withColumn("base_failed", failed)
           .withColumn("kept", ~F.col("base_failed") & (left >= min_words) & (left >= min_left * F.col("n_words"))))
    names = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words", "base_failed", "kept"]
    if not with_text:
        return out.select(*names)

    def clean(batch: pa.RecordBatch):
        n = batch.num_columns - 2
        texts = [t if t is None or not g else b"\n".join(x for x in t.encode("utf-8", "surrogatepass").split(b"\n") if not x.split() or _signed(line_key(x)[0]) not in g).decode("utf-8", "surrogatepass")
                 for t, g in ((t, set(g or ())) for t, g in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True))]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(texts, pa.string())], names=[*batch.schema.names[:n], "clean_text"])

    chosen = out.select(*names, "_text", "_gone")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-2]), "clean_text string"])
    return per_batch(chosen, clean, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


WORDS = r"'[^\x20\x09-\x0D]+'"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, host, l, array_to_string(regexp_extract_all(translate(l, {UPPER}, {LOWER}), {WORDS}), ' ') AS norm,
              len(regexp_extract_all(l, {WORDS})) AS n
       FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS l FROM d)),
lw AS (SELECT * FROM ln WHERE n > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lw GROUP BY doc_id),
hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY host),
common AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT doc_id) AS c FROM lw GROUP BY host, norm) JOIN hosts USING (host)
           WHERE c >= {MIN_DOCS} AND c > {SHARE}::DOUBLE * docs),
gone AS (SELECT doc_id, sum(n) AS n FROM lw JOIN common USING (host, norm) GROUP BY doc_id),
f AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             coalesce(gone.n, 0)::BIGINT AS n_common_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND n_words - n_common_words >= {MIN_WORDS} AND n_words - n_common_words >= {MIN_LEFT}::DOUBLE * n_words AS kept FROM b
"""
