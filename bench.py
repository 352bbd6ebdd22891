"""Benchmark: run the catalogue's registered queries at $BENCH_SF_DIR on
local[$BENCH_CPUS]. (The corpus operators' figures come from the cluster check.)

Each query is executed through the ``noop`` sink (full execution, nothing
collected to the driver); warm median of ``$BENCH_REPEATS`` runs (default 3)
after ``$BENCH_WARMUP`` warm-up passes over all queries (default 1; the first
one also records each query's row count). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    warmup = max(1, int(os.environ.get("BENCH_WARMUP", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from marquee.plans.queries import QUERIES
    from marquee.session import get_session

    spark = get_session(f"local[{cpus}]", app="marquee-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = [n for n in QUERIES if not only or n in only]

    def run(name: str, obs: Observation | None = None) -> float:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        if obs is not None:     # row count from the same job, no extra pass
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    rows, errors = {}, {}
    for name in names:          # warm-up: JIT, parquet footers, Python imports
        obs = Observation(f"rows_{name}")
        try:
            run(name, obs)
            rows[name] = obs.get["rows"]
        except Exception as e:  # one failing query must not lose the others' numbers
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    names = [n for n in names if n not in errors]
    for _ in range(warmup - 1):  # the JVM keeps compiling hot paths for a while
        for name in names:
            run(name)
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_query_median_sec", "value": total, "unit": "sec",
                      "queries": times, "rows": rows, "sf": sf, "cpus": cpus, "repeats": repeats, "warmup": warmup,
                      "shuffle_partitions": cpus, **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
