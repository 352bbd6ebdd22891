"""Merkle manifest of a dataset: one leaf a row, one tree a source, one root.

1. Leaves are hashed where rows are read (built-in ``sha2``; texts go no
   further), dealt by range of (source, id) and numbered from 0 in each source.
   Numbers come from the sizes of the ranges, so no task sees a whole source.
2. A partition of the tree is an aligned block of 16 ** DEPTH consecutive
   leaves of one source. Its task hashes the block up to one digest.
3. Butterfly exchange: in each round the (up to 16) neighbouring subtrees of a
   run swap their digests, member by member. Member ``l`` of a subtree meets
   member ``l`` of each other subtree of its run; a subtree with fewer members
   (the last of a source, a small source) sends its digest by member ``l mod
   members`` instead. Every member hashes the ancestor itself, so after the last
   round each block holds all upper siblings and the root: no pass leads down.
   The rounds over blocks of a source are followed by rounds over sources.
4. A block's task folds its leaves' proofs and its upper path together.

An exchange is a window over at most 16 rows; a hot source is many blocks like
any other. What a round ships is one digest a block and run, at most 16 times
the blocks; leaves are shuffled twice as digests.

Nulls: a null column counts as ``-``; null sources come first and are one
source, null ids come first in theirs and are never tampered with. Empty texts
are ``0:``. Rows that share a source and an id are ordered by their leaf;
repeated rows are leaves of their own. Very long texts are hashed whole. A source
of one row has its leaf as its subroot, and a dataset of one source its subroot
as its root. An empty table gives no rows. Other columns are not read, so their
names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import crc32_sql, prepare, written

FANOUT = 16
#: Levels that a block hashes on its own: 16 ** 3 = 4,096 leaves.
DEPTH = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose id has a CRC-32 that this divides are tampered with in the audit.
TAMPERED = 5


def field(c: Column | str) -> Column:
    """``-`` for a null, else UTF-8 byte count, ``:`` and the value."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column | str) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def ascii_lower(c: str) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, letters, letters.lower())


def node(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    k = 0
    while FANOUT ** k < n:
        k += 1
    return k


def levels(leaves: list[str], most: int) -> list[list[str]]:
    """The leaves and ``most`` levels of nodes above them."""
    out = [leaves]
    for _ in range(most):
        low = out[-1]
        out.append([node(low[i:i + FANOUT]) for i in range(0, len(low), FANOUT)])
    return out


def positions(df: DataFrame, *order: str) -> DataFrame:
    """The rows with ``at``, their number from 0 in the order of the columns
    (nulls first): rows are dealt by range and written, and the sizes of the
    ranges before give each its start."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(width, *keys).sortWithinPartitions(*keys))
    rows = dealt.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)    # one row a shuffle partition
    starts = rows.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_i") - F.shiftleft(F.col("_p").cast("long"), 33)
    return rows.join(F.broadcast(starts), "_p").withColumn("at", F.col("_start") + inside).drop("_p", "_i", "_start")


def numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with tree (number of their source), n (its leaves) and i (their
    number in it), written."""
    at = written(positions(leaves, "source", "doc_id", "leaf", "row"))
    sources = at.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    trees = positions(sources, "source").select(F.col("source").alias("s"), F.col("at").alias("tree"), "first", "n")
    joined = at.join(trees, at["source"].eqNullSafe(trees["s"]))
    return written(joined.select("tree", "n", (F.col("at") - F.col("first")).alias("i"), "source", "doc_id", "leaf", "tampered"))


def _exchange(blocks: DataFrame, tree: list[str], live: Column, most: Column) -> DataFrame:
    """One round. ``blocks``: node and its members' number l of c, the node's
    digest and the path so far; ``most``: members of the run's largest node."""
    run = F.floor(F.col("node") / FANOUT)
    # to its own place, and to the places that this node has no member for
    there = F.explode(F.when(F.col("l") < most, F.sequence("l", most - 1, "c")).otherwise(F.array("l")))
    sent = blocks.withColumn("live", live).withColumn("run", run).withColumn("there", there)
    group = Window.partitionBy(*tree, "run", "there").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = sent.select("*", F.collect_list("digest").over(group).alias("digests"),
                      F.collect_list("c").over(group).alias("members")).where("there = l")
    place = F.pmod("node", F.lit(FANOUT)).cast("int")       # in its run, all of whose earlier nodes are there
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    step = F.concat(place.cast("string"), F.lit(":"), F.array_join("digests", ","), F.lit(";"))
    new = {"node": F.col("run"), "l": F.col("l") + total(F.slice("members", F.lit(1), place)), "c": total("members"),
           "digest": F.sha2(F.concat_ws("", "digests"), 256), "path": F.concat("path", step)}
    return met.select(*[F.when(F.col("live"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in blocks.columns])


def butterfly(blocks: DataFrame) -> DataFrame:
    """``blocks`` (tree, blocks, block, digest: each block's root) with subroot,
    root and path (siblings from the block up to the root)."""
    size = blocks.agg(F.max("blocks"), F.max("tree")).first()
    if size[0] is None:
        return blocks.select("tree", "block", *(F.lit("").alias(c) for c in ("subroot", "root", "path")))
    b = blocks.select("tree", "blocks", "block", F.col("block").alias("node"), F.lit(0).cast("long").alias("l"),
                      F.lit(1).cast("long").alias("c"), "digest", F.lit("").alias("path"))
    for k in range(depth(size[0])):
        span = FANOUT ** k
        # the run's first node is its largest: as many blocks as the level spans, or what is left
        first = F.floor(F.col("node") / FANOUT) * (span * FANOUT)
        b = written(_exchange(b, ["tree"], F.col("blocks") > span, F.least(F.lit(span), F.col("blocks") - first)))
    # from here on a source is a node, and its blocks are the members
    b = b.select("tree", "block", F.col("tree").alias("node"), F.col("block").alias("l"), F.col("blocks").alias("c"), "digest", "path",
                 F.col("digest").alias("subroot"))
    for _ in range(depth(size[1] + 1)):
        run = F.floor(F.col("node") / FANOUT)
        most = b.groupBy(run.alias("r")).agg(F.max("c").alias("most"))
        b = written(_exchange(b.join(most, run == most["r"]).drop("r"), [], F.lit(True), F.col("most")).drop("most"))
    return b.select("tree", "block", "subroot", F.col("digest").alias("root"), "path")


def local_depth(n: int) -> int:
    return min(DEPTH, depth(n))


def _block_root(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("i")
    first = frame.iloc[0]
    digest = levels(frame["leaf"].tolist(), local_depth(int(first["n"])))[-1][0]
    return pd.DataFrame({"tree": [first["tree"]], "blocks": [-(-int(first["n"]) // FANOUT ** DEPTH)], "block": [first["block"]], "digest": [digest]})


def parse_path(path: str) -> list[tuple[int, list[str]]]:
    """(place, digests of the run) of each step."""
    steps = (s.split(":") for s in path.split(";") if s)
    return [(int(at), run.split(",")) for at, run in steps]


def fold(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for at, run in steps:
        digest = node([*run[:at], digest, *run[at + 1:]])
    return digest


def proofs(leaves: list[str], n: int, path: str) -> Iterator[list[tuple[int, list[str]]]]:
    """Steps from each of a block's leaves up to the root."""
    inside, upper = levels(leaves, local_depth(n))[:-1], parse_path(path)
    runs = [[low[i:i + FANOUT] for i in range(0, len(low), FANOUT)] for low in inside]
    for i in range(len(leaves)):
        yield [((i // FANOUT ** k) % FANOUT, runs[k][i // FANOUT ** (k + 1)]) for k in range(len(runs))] + upper


def proof_digest(steps: list[tuple[int, list[str]]]) -> str:
    return node([x for at, run in steps for k, x in enumerate(run) if k != at])


def _audit(frame: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("i")
    n, upper = int(frame["n"].iloc[0]), paths.iloc[0]
    proof, folded = [], []
    now = frame["tampered"].fillna(frame["leaf"]).tolist()
    for x, steps in zip(now, proofs(frame["leaf"].tolist(), n, upper["path"]), strict=True):
        proof.append(proof_digest(steps))
        folded.append(fold(x, steps))
    return pd.DataFrame({"doc_id": frame["doc_id"], "source": frame["source"], "leaf": frame["leaf"], "subroot": upper["subroot"], "root": upper["root"],
                         "proof_sha256": proof, "folded_root": folded, "verified": [f == upper["root"] for f in folded]})


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified
    of each row. ``tampered``: the leaf that is folded instead, null for rows
    that are as they were."""
    prepare(docs.sparkSession)
    tampered = F.lit(None).cast("string") if tampered is None else tampered
    rows = docs.select("doc_id", "source", leaf(*COLUMNS).alias("leaf"), tampered.alias("tampered"))
    leaves = numbered(written(rows).withColumn("row", F.monotonically_increasing_id()))
    dealt = leaves.withColumn("block", F.floor(F.col("i") / FANOUT ** DEPTH).cast("long"))
    blocks = written(dealt.select("tree", "block", "n", "i", "leaf").groupBy("tree", "block")
                     .applyInPandas(_block_root, "tree long, blocks long, block long, digest string"))
    paths = butterfly(blocks)
    schema = ("doc_id string, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    # ids as text: pandas would make floating point of integers beside nulls
    audited = (dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("tree", "block")
               .cogroup(paths.groupBy("tree", "block")).applyInPandas(_audit, schema))
    return audited.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def tampered_leaf(every: int = TAMPERED) -> Column:
    """The leaf with A-Z of the text lower-cased, of every row whose id's
    CRC-32 ``every`` divides; null elsewhere."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, leaf(*COLUMNS[:-1], ascii_lower("text")))


def _sql() -> str:
    """The same by SQL, level by level: 6 levels hold 16 million leaves a source
    and as many sources."""
    most = 6
    byte = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    hashed = lambda text: "sha256(" + " || ".join(byte.format(c) for c in (*COLUMNS[:-1], text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = f"coalesce({crc32_sql('doc_id::VARCHAR')} % {TAMPERED} = 0, false)"
    parts = [f"d AS (SELECT doc_id, source, {hashed('text')} AS leaf, CASE WHEN {hit} THEN {hashed(lower)} ELSE {hashed('text')} END AS now FROM documents)",
             "l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
             "s0 AS (SELECT source, i, leaf AS x FROM l)"]
    for name, key in (("s", "source"), ("t", "0")):
        if name == "t":
            parts.append(f"sub AS (SELECT source, x AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM s{most})")
            parts.append("t0 AS (SELECT 0 AS source, i, subroot AS x FROM sub)")
        for k in range(most):
            parts.append(f"{name}r{k} AS (SELECT source, i // {FANOUT} AS i, list(x ORDER BY i) AS run, max(max(i)) OVER (PARTITION BY source) AS top "
                         f"FROM {name}{k} GROUP BY source, i // {FANOUT})")
            parts.append(f"{name}{k + 1} AS (SELECT source, i, CASE WHEN top = 0 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS x FROM {name}r{k})")
    parts.append("f0 AS (SELECT l.*, sub.subroot, sub.i AS tree, '' AS proof, now AS folded FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source)")
    for k in range(2 * most):
        name, level, at = ("s", k, "i") if k < most else ("t", k - most, "tree")
        key = "f.source IS NOT DISTINCT FROM r.source" if k < most else "r.source = 0"
        own = f"(f.{at} // {FANOUT ** level}) % {FANOUT}"
        left, right = f"array_to_string(r.run[:{own}], '')", f"array_to_string(r.run[{own} + 2:], '')"
        parts.append(f"f{k + 1} AS (SELECT f.* EXCLUDE (proof, folded), CASE WHEN r.top = 0 THEN proof ELSE proof || {left} || {right} END AS proof, "
                     f"CASE WHEN r.top = 0 THEN folded ELSE sha256({left} || folded || {right}) END AS folded "
                     f"FROM f{k} f JOIN {name}r{level} r ON {key} AND r.i = f.{at} // {FANOUT ** (level + 1)})")
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, (SELECT x FROM t{most}) AS root, sha256(proof) AS proof_sha256, "
            f"folded AS folded_root, folded = (SELECT x FROM t{most}) AS verified FROM f{2 * most}")


SQL = _sql()
