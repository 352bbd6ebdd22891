"""The Merkle manifest against a plain recursive one."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle
from marquee.llm.common import prepare

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root and each node's siblings, level by level."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(where):
            first = at // 16 * 16
            run = nodes[first:first + 16]
            proofs[k].append((at - first, run))
            where[k] = at // 16
        nodes = [digest("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], proofs


def manifest_of(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in sources[s]])
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, steps in zip(sources[s], trees[s][1]):
            steps = steps + top
            now = (*r[:4], lower(r[4])) if r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0 else r
            x = leaf_of(now)
            for at, run in steps:
                x = digest("".join(run[:at]) + x + "".join(run[at + 1:]))
            proof = digest("".join(d for at, run in steps for k, d in enumerate(run) if k != at))
            out.append((r[0], leaf_of(r), trees[s][0], root, proof, x, x == root))
    return out


def rows_of(sizes, seed=0):
    rng = random.Random(seed)
    texts = [None, "", "Some Text", "plain", "Zürich Ä 😀", "x" * 5000, "İ K"]
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            i = rng.choice([None, rng.randrange(50), rng.getrandbits(62), rng.getrandbits(62), rng.getrandbits(40)])
            rows.append((i, source, rng.choice([None, "en", ""]), rng.choice([None, 0, -5, 123]), rng.choice(texts)))
    return rows + rows[:3]


def check(spark, rows, partitions=3):
    prepare(spark)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions).withColumn("root", F.lit("a clashing name")).withColumn("leaf", F.lit(1))
    found = merkle.manifest(docs, merkle.tampered_leaf()).drop("source")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, manifest_of(rows)))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 17}, {None: 3, "a": 1, "b": 16, "": 40}, {f"s{i}": 1 + i % 3 for i in range(300)}])
def test_small_trees(spark, sizes):
    check(spark, rows_of(sizes))


def test_hot_source_of_many_blocks(spark):
    """Two rounds over blocks (the last run is not full), then sources of other sizes."""
    check(spark, rows_of({"hot": 70_001, "b": 4097, "c": 2, None: 1}))


def test_repeated_rows_are_leaves(spark):
    check(spark, [(7, "a", "en", 4, "text")] * 40)


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert merkle.depth(1) == 0 and merkle.depth(16) == 1 and merkle.depth(17) == 2


def test_untampered_rows_verify(spark):
    docs = spark.createDataFrame(rows_of({"a": 30, "b": 2}), SCHEMA)
    assert merkle.manifest(docs).where("not verified").isEmpty()


def test_numbers_need_no_single_task(spark):
    """Rows of one key land in several ranges and are numbered without a gap."""
    rows = spark.range(1000).select(F.lit("same").alias("k"), (F.col("id") * 7 % 1000).alias("v"))
    at = merkle.positions(rows, "k", "v").collect()
    assert sorted((r["at"], r["v"]) for r in at) == [(i, i) for i in range(1000)]
