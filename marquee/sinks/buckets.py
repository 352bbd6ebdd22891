"""Reading bucketed tables: the join key's hash is the storage.

A scan by buckets gives each bucket to one task, so an aggregate or join on
the bucket key needs no shuffle. That holds a hot key against it: the bucket
of a key with a third of all rows is one task, which nothing splits. The sizes
of the buckets are known from the file listing, so the choice is made per
read: tables whose buckets are all below a limit are scanned by bucket, others
by plain splits, where partial aggregates combine a hot key in many tasks
before the shuffle. Both reads give the same rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from marquee.sinks.tables import _fs_path, stored_buckets

#: Largest bucket (bytes of files, all columns) that one task is given.
MOST_BYTES = 1024 ** 3


def location(spark: SparkSession, name: str) -> str:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return told["Location"]


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket by the names of the files (one listing)."""
    fs, p = _fs_path(spark, path)
    out: Counter = Counter()
    for f in fs.listStatus(p):
        if m := re.search(r"_(\d{5,})(?:\.c\d+)?\.[^/]*parquet$", f.getPath().getName()):
            out[int(m[1])] += f.getLen()
    return dict(out)


def read_bucketed(spark: SparkSession, name: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The table's rows: by bucket, unless a bucket is too large for a task."""
    if stored_buckets(spark, name) is None:
        return spark.table(name)
    path = location(spark, name)
    if max(bucket_bytes(spark, path).values(), default=0) <= most_bytes:
        return spark.table(name)
    return spark.read.schema(spark.table(name).schema).parquet(path)
