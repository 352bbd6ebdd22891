"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.session import ensure_checkpoint_dir

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Odd 64-bit multipliers for the integer mixers below.
MUL1, MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
NO_ID = (1 << 63) - 1
#: glibc settings of Python workers: large arrays go back to the system when
#: they are freed, so a worker that many stages reuse doesn't keep its peak.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "4194304", "MALLOC_TRIM_THRESHOLD_": "4194304"}


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder set, and this package importable in Python workers
    that start without it on their path (local runs from another folder; a
    cluster gets the package by --py-files or from its image)."""
    ensure_checkpoint_dir(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, REPO])
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder: later readers
    don't compute them again, and a lost executor takes nothing with it."""
    prepare(df.sparkSession)
    return df.checkpoint()


def per_batch(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """mapInArrow with ``fn``: RecordBatch -> RecordBatch, one by one."""
    def run(batches: Iterator):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
    return df.mapInArrow(run, schema)


def without_clash(docs: DataFrame, keep: Sequence[str], made: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` and ``keep`` with other names for kept columns that are named
    like an operator's own columns or each other: ``<name>_kept``."""
    taken, out = {c.lower() for c in made}, []
    for k in keep:
        name = k
        while name.lower() in taken or name != k and name.lower() in (c.lower() for c in docs.columns):
            name += "_kept"
        if name != k:
            docs = docs.withColumn(name, docs[k])
        taken.add(name.lower())
        out.append(name)
    return docs, out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MUL1
    x = x ^ (x >> np.uint64(27))
    x = x * MUL2
    return x ^ (x >> np.uint64(31))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text's UTF-8 bytes (DuckDB has no
    function for it; the SQL that the queries are held against needs one)."""
    byte = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    bit = "list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    return f"xor(list_reduce({byte}, lambda c, b: {bit}, 4294967295::BIGINT), 4294967295::BIGINT)"


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... (count numbers) of each pair, one after the other."""
    if not len(counts) or not counts.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)


def chunk_id(number: int, content: bytes) -> int:
    """Name of the ``number``-th chunk of this task's partition; a task that
    runs again gives its chunks the same names."""
    from pyspark import TaskContext

    task = TaskContext.get()
    place = (task.partitionId() if task else 0, number)
    return xxhash.xxh3_64_intdigest(repr(place).encode() + content) >> 1


class Memo(dict):
    """A dict that fills itself by ``make`` and starts anew when it holds
    ``most`` keys, so its memory is bounded whatever the vocabulary."""

    def __init__(self, make: Callable, most: int = 200_000):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; root: the smallest node
    that its edges reach.

    Rounds of contraction: each node points to its neighbour that comes first
    in a fixed shuffled order, pointers are followed once more, edges move to
    the ends of the pointers, and edges inside one node go. The shuffled order
    makes a chain shrink by a constant factor a round. Each round's edges and
    pointers are written, so no lineage grows; the number of rounds follows
    the logarithm of the longest path.
    """
    key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    e = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
                .select(key("a").alias("a"), key("b").alias("b")).distinct())
    names = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = written(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n"))
                        .select("v", F.least("v", "n").alias("p")))
        up = first.select(F.col("v").alias("p"), F.col("p").alias("q"))
        point = written(first.join(up, "p").select("v", F.col("q").alias("p")))
        if names is None:
            names = point.select(F.col("v").alias("node"), F.col("p").alias("root"))
        else:
            step = point.select(F.col("v").alias("root"), F.col("p").alias("next"))
            names = written(names.join(step, "root", "left")
                            .select("node", F.coalesce("next", "root").alias("root")))
        pa = point.select(F.col("v").alias("a"), F.col("p").alias("x"))
        pb = point.select(F.col("v").alias("b"), F.col("p").alias("y"))
        e = written(e.join(pa, "a").join(pb, "b").where("x <> y")
                    .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if names is None:
        return e.select(F.col("a.v").alias("node"), F.col("b.v").alias("root"))
    flat = names.select(F.col("node.v").alias("node"), F.col("root.v").alias("r"))
    least = flat.groupBy("r").agg(F.min("node").alias("root"))
    return flat.join(least, "r").select("node", "root")
