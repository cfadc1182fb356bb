"""Run the reports and write one CSV folder per report.

    python -m riskloom --sf-dir /path/to/tables --out /shared/reports [--reports a,b]

``--sf-dir`` holds the driver tables the domain is derived from.  ``--out``
should be shared storage on a cluster.  A report has as many files as its last
stage has tasks (one for the category reports).
"""

from __future__ import annotations

import argparse
import sys

def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riskloom")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--reports", default="", help="comma-separated keys (default: all)")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from riskloom.plans.registry import all_queries
    from riskloom.session import build_session, release_scratch, report_settings
    from riskloom.sources.warehouse import write_report_csv

    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    report_settings(spark)
    queries = all_queries()
    names = [n for n in args.reports.split(",") if n] or sorted(queries)
    unknown = [n for n in names if n not in queries]
    if unknown:
        print(f"unknown reports: {unknown}", file=sys.stderr)
        return 2
    for name in names:
        write_report_csv(queries[name](spark, args.sf_dir), f"{args.out.rstrip('/')}/{name}")
        release_scratch(spark)  # the report is written: its intermediate tables can go
        print(f"wrote {name}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
