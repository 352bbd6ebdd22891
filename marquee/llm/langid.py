"""Language identification of whole texts, word by word.

A word is a run of letters. The script of its first letter (``SCRIPTS``)
leaves only the languages that use that script in the labelled texts; each of
those gets the sum of the log-probabilities of the word's letter trigrams
(word edges included). Viterbi then labels the words of a text: staying in a
language is free, switching costs ``switch_cost``, so mixed texts fall into
spans. The language that labels most letters is the prediction, its share of
the scored letters the score.

The model is a table of 2^16 trigram cells for each language, so its size
follows the number of languages alone. It is fitted on a bounded sample: of
each language the ``sample_rows`` distinct labelled texts whose hashes are
smallest, whole texts; copies of a text count once, however many there are.

Nulls: null texts and texts without a letter are ``und`` with score 0; texts
whose letters are all of scripts that no learned language uses get the
language that sorts first, with score 0. Rows with a null language teach
nothing. Ties go to the language that sorts first. Without any
labelled row everything is ``und``. Very long texts are read whole; repeated
rows get the same result; an empty table gives no rows. Other columns than
``keep`` are left out; a kept one named like a result gets ``_kept`` after its name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import prepare, without_clash

SAMPLE_ROWS, SWITCH_COST, UNKNOWN = 3000, 12.0, "und"
CELLS = 1 << 16
#: Letters of text that are handled at once; a longer single text is a slice of its own.
SLICE_CHARS = 1_000_000
#: First and last code point of the blocks of each script (Unicode).
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}
N_SCRIPTS = len(SCRIPTS) + 1
_TABLES: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter; number of its script (0: none of the list)."""
    if not _TABLES:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x30000)), bool, 0x30000)
        script = np.zeros(0x110000, np.uint8)
        for k, blocks in enumerate(SCRIPTS.values()):
            for a, b in blocks:
                script[a:b + 1] = k + 1
        _TABLES.extend((np.concatenate([letter, np.fromiter((chr(i).isalpha() for i in range(0x30000, 0x110000)), bool, 0xE0000)]), script))
    return _TABLES[0], _TABLES[1]


class Words:
    """The words of many texts, side by side."""

    def __init__(self, texts: Sequence[str]):
        letter, script = tables()
        coded = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
        c = np.frombuffer(b"\0\0\0\0".join([b"", *coded, b""]), "<u4")
        is_letter = letter[np.minimum(c, 0x10FFFF)]
        c = np.where(is_letter, c, 0).astype(np.uint32)
        edge = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        at = np.flatnonzero(is_letter)
        h = c[at - 1] * np.uint32(0x9E3779B1) + c[at] * np.uint32(0x85EBCA6B) + c[at + 1] * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        self.cell = (h >> np.uint32(16)).astype(np.int64)
        self.size = self.end - self.start
        self.script = script[c[self.start]]
        text_ends = np.cumsum([len(x) // 4 + 1 for x in coded])
        self.first = np.concatenate([[0], np.searchsorted(self.start, text_ends)])  # of each text's words

    def gram_starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.size)[:-1]]) if len(self.size) else np.zeros(0, np.int64)


def viterbi(scores: np.ndarray, first: np.ndarray, cost: float) -> np.ndarray:
    """Best label of each row of ``scores``; texts are rows first[i]:first[i + 1].

    All texts step together, the longest first, so a step is one operation on
    those that still have words.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    length, at = n[order], first[:-1][order]
    label = np.zeros(len(scores), np.int64)
    alive = int((length > 0).sum())
    if not alive:
        return label
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int16)
    own = np.arange(scores.shape[1], dtype=came.dtype)
    value = scores[at[:alive]].astype(np.float64)
    for t in range(1, int(length[0])):
        while length[alive - 1] <= t:
            label[at[alive - 1] + t - 1] = value[alive - 1].argmax()
            alive -= 1
        v = value[:alive]
        best = v.argmax(axis=1)
        top = v[np.arange(alive), best] - cost
        switch = top[:, None] > v
        i = at[:alive] + t
        came[i] = np.where(switch, best[:, None], own)
        value = np.where(switch, top[:, None], v) + scores[i]
    t = int(length[0])
    for k in range(alive):
        label[at[k] + t - 1] = value[k].argmax()
    alive = 0
    for t in range(int(length[0]) - 1, 0, -1):
        while alive < len(length) and length[alive] > t:
            alive += 1
        i = at[:alive] + t
        label[i - 1] = came[i, label[i]]
    return label


class Model:
    """Log-probabilities (cell, language) and which languages each script leaves."""

    def __init__(self, languages: Sequence[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = list(languages)
        total = counts.sum(axis=1, keepdims=True)
        self.logp = np.ascontiguousarray(np.log((counts + 0.1) / (total + 0.1 * CELLS)).T.astype(np.float32))
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = (share >= 0.01).T  # (script, language)
        self.uses[0] = False

    def predict(self, texts: Sequence[str | None], cost: float, spans: bool = False) -> tuple[list[str], list[float], list]:
        n, k = len(texts), len(self.languages)
        if not k:
            return [UNKNOWN] * n, [0.0] * n, [[] for _ in texts]
        w = Words([t or "" for t in texts])
        scores = np.zeros((len(w.size), k), np.float64)
        if len(w.size):
            starts = w.gram_starts()
            for j in range(k):
                scores[:, j] = np.add.reduceat(self.logp[w.cell, j], starts, dtype=np.float64)
        uses = self.uses[w.script]
        known = uses.any(axis=1)
        scores = np.where(uses, scores, np.where(known, -1e6, 0.0)[:, None])
        label = viterbi(scores, w.first, cost)
        text = np.repeat(np.arange(n), np.diff(w.first))
        letters = np.bincount(text[known] * k + label[known], weights=w.size[known], minlength=n * k).reshape(n, k)
        total = letters.sum(axis=1)
        best = letters.argmax(axis=1)
        score = letters[np.arange(n), best] / np.maximum(total, 1)
        found = [self.languages[b] if words else UNKNOWN for b, words in zip(best, np.diff(w.first), strict=True)]
        runs: list = []
        if spans:
            for i in range(n):
                own = np.arange(w.first[i], w.first[i + 1])[known[w.first[i]:w.first[i + 1]]]
                cut = np.flatnonzero(np.diff(label[own])) + 1
                runs.append([(self.languages[label[p[0]]], len(p)) for p in np.split(own, cut) if len(p)])
        return found, score.tolist(), runs


def slices(texts: Sequence[str | None], most: int = SLICE_CHARS):
    """Consecutive slices of about ``most`` characters; no text is cut."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of the languages of ``labelled``, from the at most ``sample_rows``
    distinct texts of each language whose hashes are smallest."""
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # the distinct texts of a language with the smallest hashes: copies of a text are one row of the sample
    hashed = rows.withColumn("h", F.xxhash64("text", "lang"))
    sizes = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, CELLS)), np.zeros((0, N_SCRIPTS)))
    # a little more than enough by the share of hashes, then exactly the smallest ones
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, 1.2 * sample_rows / n)))])
    low = hashed.where((F.col("h").cast("double") + 2.0 ** 63) / 2.0 ** 64 <= share[F.col("lang")])
    one = low.groupBy("lang", "h").agg(F.first("text").alias("text"))
    least = Window.partitionBy("lang").orderBy("h")
    sample = (one.withColumn("i", F.row_number().over(least)).where(F.col("i") <= sample_rows).select("lang", "text", "i")
              .repartition(16, "lang", "i").select("lang", "text"))

    def count(frames):
        cells: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for f in frames:
            for name, g in f.groupby("lang"):
                texts = g["text"].tolist()
                for a, b in slices(texts):
                    w = Words(texts[a:b])
                    cells[name] = cells.get(name, 0) + np.bincount(w.cell, minlength=CELLS)
                    scripts[name] = scripts.get(name, 0) + np.bincount(w.script, weights=w.size, minlength=N_SCRIPTS)
        if cells:
            yield pd.DataFrame({"lang": list(cells), "cells": [x.astype("<i8").tobytes() for x in cells.values()], "scripts": [x.astype("<f8").tobytes() for x in scripts.values()]})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        cells = sum(np.frombuffer(x, "<i8") for x in f["cells"])
        scripts = sum(np.frombuffer(x, "<f8") for x in f["scripts"])
        return pd.DataFrame({"lang": f["lang"][:1], "cells": [cells.tobytes()], "scripts": [scripts.tobytes()]})

    kind = "lang string, cells binary, scripts binary"
    found = sorted(sample.mapInPandas(count, kind).groupBy("lang").applyInPandas(add, kind).collect())
    return Model([r["lang"] for r in found], np.array([np.frombuffer(r["cells"], "<i8") for r in found], np.float64).reshape(len(found), CELLS),
                 np.array([np.frombuffer(r["scripts"], "<f8") for r in found]).reshape(len(found), N_SCRIPTS))


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text", switch_cost: float = SWITCH_COST, spans: bool = False) -> DataFrame:
    """``keep``, lang_pred, score (and spans: language and words of each run)."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    docs, keep = without_clash(docs, keep, ("lang_pred", "score", "spans"))
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), "lang_pred string, score double", *["spans array<struct<lang:string,words:int>>"] * spans])
    kept, at = len(keep), [*keep, text].index(text)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in slices(texts):
                lang, score, runs = shared.value.predict(texts[a:b], switch_cost, spans)
                arrays = [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                if spans:
                    arrays.append(pa.array([[{"lang": x, "words": n} for x, n in r] for r in runs], span_type))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(kept)), *arrays], names=[*keep, "lang_pred", "score", *["spans"] * spans])

    return docs.select(*(docs[k] for k in keep), *[docs[text]] * (text not in keep)).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that teaches nothing; a null id is in the teaching fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
