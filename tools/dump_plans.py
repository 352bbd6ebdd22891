"""Write PLANS.md: the final adaptive plan of every registered catalogue query
(as it ran), the plans of the copies it made on the way, and the pushed
filters and read schema of each parquet scan.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def tree(df) -> str:
    """Operators of the executed plan, without expression lists."""
    text = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    lines = []
    for line in text.splitlines():
        m = re.match(r"([ :+|-]*(?:\*\(\d+\) )?)(\w+)(.*)", line)
        if not m or m[2] in ("AdaptiveSparkPlan", "Final", "ResultQueryStage", "ShuffleQueryStage", "BroadcastQueryStage"):
            continue
        rest = m[3]
        if m[2] == "FileScan":
            where = re.search(r"Location: \w+\(\d+ paths\)\[file:([^\],]*)", rest)
            pushed, schema = re.search(r"PushedFilters: (\[.*?\])", rest), re.search(r"ReadSchema: (.*)$", rest)
            parts = re.search(r"PartitionFilters: (\[[^\]].*?\]), PushedFilters", rest)
            kind = (" Bucketed" if "Bucketed: true" in rest else "") + (f" PartitionFilters {parts[1]}" if parts else "")
            rest = f" {os.path.basename(where[1]) if where else '?'}{kind} PushedFilters {pushed[1] if pushed else '[]'} ReadSchema {schema[1] if schema else '?'}"
        elif m[2] == "BatchScan":
            pushed = re.search(r"PushedAggregation: (\[[^\]]*\])", rest)
            rest = f" PushedAggregation {pushed[1] if pushed else '[]'}"
        elif m[2] == "Exchange":
            rest = " " + rest.strip().split(",")[0].split("(")[0]
        else:
            rest = ""
        lines.append((m[1] + m[2] + rest)[:220])
    return "\n".join(lines)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql.classic.dataframe import DataFrame

    from marquee.plans.queries import QUERIES
    from marquee.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Plans as they ran", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (`local[8]`, 8 shuffle partitions, AQE on): final adaptive plans, operators",
           "only, with the scans' filters and columns. A query that checkpoints or writes a copy lists that job's plan first.", ""]
    real, copies = DataFrame.checkpoint, []

    def spy(self, *a, **k):
        made = real(self, *a, **k)
        copies.append(tree(self))
        return made

    DataFrame.checkpoint = spy
    for name, fn in QUERIES.items():
        copies.clear()
        df = fn(spark, sf)
        df.collect()
        final = tree(df)
        out += [f"## {name}", "", f"Shuffles of the result's job: {len(re.findall(r'(?<!Broadcast)Exchange ', final))}", ""]
        for c in copies:
            out += ["Copy:", "", "```", c, "```", ""]
        out += ["```", final, "```", ""]
    with open(os.path.join(HERE, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
