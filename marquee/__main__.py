"""Command line: ``python -m marquee {run,add,verify,reports} ...``.

* ``run``     raw CSV (file, folder or glob) -> cleaned tables, rejects and marts,
              every table swapped in whole.
* ``add``     raw CSV as batch N -> added to the stored partial sums, marts refreshed
              from them.
* ``verify``  print the verification reads (top ROI, tag counts, row counts,
              first rows of each mart).
* ``reports`` write the five chart datasets (one folder each) as CSV or parquet.

Tables are folders of checked versions under ``--warehouse`` (default:
``<spark.sql.warehouse.dir>/marquee``), so each command can be a process of its
own; pass ``--prefix`` to keep several runs apart. With ``--input-gb``,
``--executors`` and ``--cores`` the session's widths follow the input.
"""

from __future__ import annotations

import argparse
import json

from marquee.session import cluster_conf, get_session


def _cmd_run(spark, a) -> None:
    from marquee.plans.pipeline import run_pipeline
    from marquee.sources import read_raw_csv
    columns = a.columns.split(",") if a.columns else None
    raw = read_raw_csv(spark, a.input, columns=columns, multi_line=not a.single_line)
    counts = run_pipeline(spark, raw, root=a.warehouse, prefix=a.prefix, rank_impl=a.rank, buckets=a.buckets, check_links=a.check_links)
    print(json.dumps(counts))


def _cmd_add(spark, a) -> None:
    from marquee.plans.pipeline import run_batch
    from marquee.sources import read_raw_csv
    columns = a.columns.split(",") if a.columns else None
    raw = read_raw_csv(spark, a.input, columns=columns, multi_line=not a.single_line)
    print(json.dumps(run_batch(spark, raw, a.batch, root=a.warehouse, prefix=a.prefix)))


def _cmd_verify(spark, a) -> None:
    from marquee.operators.verify import verify
    from marquee.plans.pipeline import attach_run
    p = a.prefix
    attach_run(spark, p, a.warehouse)
    out = verify(spark.table(f"{p}movies"), spark.table(f"{p}movie_genres"),
                 spark.table(f"{p}mart_genre_analysis"), spark.table(f"{p}mart_country_analysis"), tie=("title", "release_year"))
    for name, df in out.items():
        print(f"--- {name} ---")
        for row in df.collect():      # each is a top-k or a one-row count
            print(tuple(row))


def _cmd_reports(spark, a) -> None:
    from marquee.operators import reports
    from marquee.plans.pipeline import attach_run, load_marts
    attach_run(spark, a.prefix, a.warehouse)
    m = load_marts(spark, a.prefix)
    stored = spark.table(f"{a.prefix}mart_top_movies")     # its report needs no sorted read
    sets = {
        "01_genre_revenue": reports.genre_revenue(m["genres"]),
        "02_budget_vs_revenue": reports.budget_vs_revenue(stored),
        "03_top_movies": reports.top_titles(stored, tie=("title", "release_year")),
        "04_country_analysis": reports.countries(m["countries"]),
        "05_roi_by_genre": reports.roi_by_tag(m["genres"]).orderBy("avg_roi", "genre"),
    }
    for name, df in sets.items():
        w = df.write.mode("overwrite")
        path = f"{a.output.rstrip('/')}/{name}"
        (w.option("header", True).csv(path) if a.format == "csv" else w.parquet(path))
        print(f"wrote {path}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="marquee")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--prefix", default="", help="table name prefix")
    ap.add_argument("--warehouse", default=None, help="folder of the tables (default: <spark.sql.warehouse.dir>/marquee)")
    ap.add_argument("--input-gb", type=float, default=None, help="input size that sets scan and shuffle widths")
    ap.add_argument("--executors", type=int, default=1)
    ap.add_argument("--cores", type=int, default=8, help="of one executor")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("input")
    r.add_argument("--columns", default=None, help="comma list of the expected CSV header")
    r.add_argument("--single-line", action="store_true", help="splittable CSV without quoted newlines")
    r.add_argument("--rank", choices=("window", "global"), default="global",
                   help="mart rank: range-bucketed (any number of groups) or one window (few groups)")
    r.add_argument("--buckets", type=int, default=None, help="store titles and tags by hash of the title, in this many buckets")
    r.add_argument("--check-links", action="store_true", help="reject tag rows whose title was not loaded")
    b = sub.add_parser("add")
    b.add_argument("input")
    b.add_argument("--batch", type=int, required=True, help="number of the batch; the last one may be loaded again")
    b.add_argument("--columns", default=None, help="comma list of the expected CSV header")
    b.add_argument("--single-line", action="store_true", help="splittable CSV without quoted newlines")
    sub.add_parser("verify")
    rp = sub.add_parser("reports")
    rp.add_argument("output")
    rp.add_argument("--format", choices=("csv", "parquet"), default="csv")
    a = ap.parse_args(argv)
    sized = cluster_conf(int(a.input_gb * 1024 ** 3), a.cores, a.executors) if a.input_gb else None
    spark = get_session(a.master, extra=sized)
    {"run": _cmd_run, "add": _cmd_add, "verify": _cmd_verify, "reports": _cmd_reports}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
