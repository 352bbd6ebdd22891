"""Spelling variants: words one edit apart, each with its commoner form.

1. Runs of letters are counted where texts are read (combined by task before
   the shuffle, so a word that every document holds is one row a task).
2. A word is a point: how often it holds each letter. One replaced letter takes
   one count down and another up, one inserted letter one count up; so the L1
   distance is at most two, and a point's box reaches one step up and one down.
3. Words of one length are dealt to cells by a k-d tree over these points. Its
   cuts come from a bounded sample of the length (SAMPLE); every word is dealt.
   A word is a query to the trees of its own length, the next shorter and the
   next longer: it goes to the cells that its box reaches, whatever their number.
4. In a cell a finer k-d tree over its words is searched the same way, leaves
   are compared by common letters, and the letter order of what is left is
   verified. A cell gives one row a query: its near words' number and the best.
5. The best over all cells is a word's form if it is common enough, and forms
   are followed to the root by doubling (counts grow by the factor each step, so
   a path has at most 27 steps).

Cells are cut to about CELL words; words of the very same letters (anagrams)
can't be told apart by a tree and share a cell.

Nulls: null and empty texts have no words; a null id is written as nothing in
the text that the damage is drawn by. Repeated rows are counted as often as
they occur; ids that occur with several texts are damaged alike. Very long
texts are read slice by slice, very long words are words like others. Ties of
forms go to the first in code point order. An empty table gives no rows. Other
columns are not read, so their names can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm.common import crc32_sql, prepare, written

LETTERS = 26 + 64                   # a-z and U+00C0-U+00FF
RUN = re.compile("[a-zÀ-ÿ]+")
OTHER = re.compile("[^a-zÀ-ÿ]")
DAMAGE = 199
LEAST_LETTERS, LEAST_COUNT, FACTOR = 6, 5, 5
#: Words of a cell, about; sampled words of a length at most; words of a leaf in a cell.
CELL, SAMPLE, LEAF = 4096, 16384, 32
SLICE = 1 << 20
KEPT = 200_000                      # distinct words that a task counts before it passes them on
POINT = 2                           # role of a word in its own cell; as a query: its length less the cell's


def runs(text: str) -> Iterator[list[str]]:
    """Runs of letters with A-Z lower-cased, slice by slice."""
    low = text.encode().lower().decode()        # bytes: only ASCII changes
    at = 0
    while at < len(low):
        cut = OTHER.search(low, at + SLICE)
        end = cut.start() if cut else len(low)
        yield RUN.findall(low, at, end)
        at = end


def damaged(run: str, base: int, every: int) -> str:
    h = zlib.crc32(run.encode(), base)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = DAMAGE, letters: int = LEAST_LETTERS,
                count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of enough letters and occurrences."""
    def count_batches(batches):
        seen: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = zlib.crc32(f"{'' if i is None else i}:".encode())
                for found in runs(t or ""):
                    for run, n in Counter(found).items():
                        word = damaged(run, base, every) if len(run) >= letters else ""
                        if len(word) >= letters:
                            seen[word] += n
                if len(seen) > KEPT:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
                    seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    counted = docs.select(docs[id_col], docs[text]).mapInArrow(count_batches, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def codes(words: list[str]) -> np.ndarray:
    """Letters' numbers of words of one length, one row a word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    flat = np.where(flat < 0xC0, flat - ord("a"), flat - 0xC0 + 26)
    return flat.astype(np.uint8).reshape(len(words), -1)


def points(code: np.ndarray) -> np.ndarray:
    """How often each word holds each letter."""
    n, length = code.shape
    at = np.arange(n)[:, None] * LETTERS + code
    return np.bincount(at.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.uint8 if length < 256 else np.int32)


class Tree:
    """Cuts of a k-d tree: below ``cut`` in letter ``dim`` goes to ``low``, the
    rest to ``high``; a child below zero is the leaf ~child."""

    def __init__(self, nodes: list[tuple[int, int, int, int]]):
        self.nodes = nodes

    @classmethod
    def build(cls, p: np.ndarray, size: int) -> tuple[Tree, list[np.ndarray]]:
        nodes: list[list[int]] = []
        leaves: list[np.ndarray] = []
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(p)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            cut = cls._cut(p[rows]) if len(rows) > size else None
            if cut is None:
                at = ~len(leaves)
                leaves.append(rows)
            else:
                at = len(nodes)
                nodes.append([*cut, 0, 0])
                low = p[rows, cut[0]] < cut[1]
                todo += [(rows[low], at, 2), (rows[~low], at, 3)]
            if parent >= 0:
                nodes[parent][side] = at
        return cls([tuple(n) for n in nodes]), leaves

    @staticmethod
    def _cut(p: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that part the points most evenly."""
        best, found = 0, None
        for d in np.argsort(-p.var(axis=0))[:6]:
            for c in np.unique(p[:, d])[1:]:
                less = int((p[:, d] < c).sum())
                if min(less, len(p) - less) > best:
                    best, found = min(less, len(p) - less), (int(d), int(c))
        return found

    def visit(self, q: np.ndarray, up: bool, down: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``q`` whose box reaches it). The box takes one step up
        in one letter (if ``up``) and one step down in one letter (if ``down``)."""
        none = np.full(len(q), -1 if up else -2, np.int16)
        todo = [(0 if self.nodes else -1, np.arange(len(q)), none, np.full(len(q), -1 if down else -2, np.int16))]
        while todo:
            at, rows, ups, downs = todo.pop()
            if not len(rows):
                continue
            if at < 0:
                yield ~at, rows
                continue
            dim, cut, low, high = self.nodes[at]
            x = q[rows, dim].astype(np.int32)
            step = (x == cut) & ((downs == -1) | (downs == dim))
            go = (x < cut) | step
            todo.append((low, rows[go], ups[go], np.where(step, dim, downs)[go].astype(np.int16)))
            step = (x == cut - 1) & ((ups == -1) | (ups == dim))
            go = (x >= cut) | step
            todo.append((high, rows[go], np.where(step, dim, ups)[go].astype(np.int16), downs[go]))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one edit; ``b`` is as long or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    differ = np.concatenate([a != b[:, :-1], np.ones((len(a), 1), bool)], axis=1)
    first = differ.argmax(axis=1)                       # letters that agree from the left
    differ = np.concatenate([a != b[:, 1:], np.ones((len(a), 1), bool)], axis=1)[:, ::-1]
    differ = np.concatenate([differ[:, 1:], np.ones((len(a), 1), bool)], axis=1)
    return first + differ.argmax(axis=1) >= n           # and from the right


def near_pairs(code: np.ndarray, p: np.ndarray, tree: Tree, leaves: list[np.ndarray], qcode: np.ndarray, kind: int):
    """(query, word) numbers of words one edit apart; the queries are ``kind``
    letters longer than the words."""
    q = points(qcode)
    short = min(qcode.shape[1], code.shape[1])
    for leaf, rows in tree.visit(q, kind <= 0, kind >= 0):
        words = leaves[leaf]
        part = max(1, 4_000_000 // (len(words) * LETTERS))
        for at in range(0, len(rows), part):
            r = rows[at:at + part]
            common = np.minimum(q[r][:, None, :], p[words][None, :, :]).sum(axis=2, dtype=np.int32)
            i, j = np.nonzero(common == (short - 1 if kind == 0 else short))
            for b in range(0, len(i), max(1, 4_000_000 // code.shape[1])):
                x, y = r[i[b:b + 4_000_000 // code.shape[1] or b + 1]], words[j[b:b + 4_000_000 // code.shape[1] or b + 1]]
                ok = one_edit(qcode[x], code[y]) if kind <= 0 else one_edit(code[y], qcode[x])
                yield x[ok], y[ok]


def _search(frame: pd.DataFrame) -> pd.DataFrame:
    """One row a query that has near words here: their number and the best."""
    out = {"word": [], "n_near": [], "less": [], "near": []}
    own = frame[frame["kind"] == POINT].sort_values(["n", "word"], ascending=[False, True])
    if len(own):
        words, counts = own["word"].tolist(), own["n"].to_numpy()
        code = codes(words)
        p = points(code)
        tree, leaves = Tree.build(p, LEAF)
        for kind in (-1, 0, 1):
            asked = frame.loc[frame["kind"] == kind, "word"].tolist()
            for at in range(0, len(asked), 16384):
                queries = asked[at:at + 16384]
                found = list(near_pairs(code, p, tree, leaves, codes(queries), kind))
                if found:
                    x, y = (np.concatenate(c) for c in zip(*found, strict=True))
                    number = np.bincount(x, minlength=len(queries))
                    best = np.full(len(queries), len(words))
                    np.minimum.at(best, x, y)           # words stand from the best on
                    for k in np.flatnonzero(number):
                        out["word"].append(queries[k])
                        out["n_near"].append(int(number[k]))
                        out["less"].append(-int(counts[best[k]]))
                        out["near"].append(words[best[k]])
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in out.items()})


def length_trees(spark: SparkSession, words: DataFrame, cell: int, sample: int) -> dict[int, Tree]:
    """A tree for each length of more than ``cell`` words, fitted on at most
    about ``sample`` of them in a task for each length; only cuts come back."""
    size = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words")).where(F.col("words") > cell)
    some = (words.withColumn("length", F.length("word")).join(size, "length")
            .where(F.pmod(F.xxhash64("word"), F.ceil(F.col("words") / sample)) == 0).select("length", "words", "word"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        leaf = max(8, int(len(frame) * cell / frame["words"].iloc[0]))
        tree, _ = Tree.build(points(codes(frame["word"].tolist())), leaf)
        return pd.DataFrame([(frame["length"].iloc[0], k, *n) for k, n in enumerate(tree.nodes)], columns=["length", "node", "dim", "cut", "low", "high"])

    nodes = some.groupBy("length").applyInPandas(fit, "length int, node int, dim int, cut int, low int, high int").toPandas()
    return {int(length): Tree([tuple(map(int, n)) for n in g.sort_values("node")[["dim", "cut", "low", "high"]].to_numpy()])
            for length, g in nodes.groupby("length")}


def dealt(words: DataFrame, trees) -> DataFrame:
    """Each word in its own cell and, as a query, in the cells its box reaches."""
    def deal(batches):
        empty = Tree([])
        for batch in batches:
            word = np.array(batch.column(0).to_pylist(), object)
            n = batch.column(1).to_numpy()
            length = np.fromiter(map(len, word), np.int64, len(word))
            for size in np.unique(length).tolist():
                rows = np.flatnonzero(length == size)
                q = points(codes(word[rows].tolist()))
                for to, kind in ((size, POINT), (size + 1, -1), (size, 0), (size - 1, 1)):
                    for cell, found in trees.value.get(to, empty).visit(q, kind in (-1, 0), kind in (0, 1)):
                        r = rows[found]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), to, np.int32)), pa.array(np.full(len(r), cell, np.int32)),
                                                          pa.array(np.full(len(r), kind, np.int32)), pa.array(word[r].tolist(), pa.string()), pa.array(n[r])],
                                                         names=["length", "cell", "kind", "word", "n"])

    return words.mapInArrow(deal, "length int, cell int, kind int, word string, n long")


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, near, near_n) of each of ``words`` (word, n; written rows)
    that has a word one edit apart: their number, the commonest and its count."""
    spark = words.sparkSession
    trees = spark.sparkContext.broadcast(length_trees(spark, words, cell, sample))
    found = dealt(words, trees).groupBy("length", "cell").applyInPandas(_search, "word string, n_near long, less long, near string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last."""
    to = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not to.where("moved").isEmpty():
        step = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = written(to.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return to.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = DAMAGE, letters: int = LEAST_LETTERS,
                      count: int = LEAST_COUNT, factor: int = FACTOR, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    prepare(docs.sparkSession)
    words = written(word_counts(docs, id_col, text, every, letters, count))
    common = F.col("near_n") >= factor * F.col("n")
    formed = written(words.join(near_words(words, cell, sample), "word", "left")
                     .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(common, F.col("near")).alias("form"), F.when(common, F.col("near_n")).alias("form_n")))
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
l AS (SELECT id, translate(r, '{_UPPER}', '{_UPPER.lower()}') AS w, count(*) AS c FROM r GROUP BY 1, 2),
h AS (SELECT w, c, {crc32_sql("id || ':' || w")} AS h FROM l),
v AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM h),
words AS (SELECT word, sum(c)::BIGINT AS n FROM v WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN d b ON a.word = b.rest
      UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN words b ON a.rest = b.word),
b AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
             row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM p),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= {FACTOR} * w.n THEN b.near END AS form,
             CASE WHEN b.near_n >= {FACTOR} * w.n THEN b.near_n END AS form_n
      FROM words w LEFT JOIN b ON w.word = b.word AND b.k = 1),
t AS (SELECT word, word AS at, form AS next FROM f
      UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON t.next = f.word)
SELECT f.word, f.form, t.at AS root, f.n, f.n_near, f.form_n FROM f JOIN t ON f.word = t.word AND t.next IS NULL
"""
