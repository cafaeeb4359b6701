"""End-to-end job: build -> quality gate -> audit metrics -> publish.

    spark-submit --conf spark.checkpoint.dir=<shared folder> lakestar/run.py --data <tables dir> [options]
    python -m lakestar.run --local --data /root/testdata/sf0.01 --no-gate

The session comes from ``SparkSession.builder.getOrCreate()`` (cluster
settings from spark-submit); ``--local`` starts a local test session instead.
Every step is a distributed Spark job; the driver only collects the quality
report (one row per check) and prints the one-row KPI summary.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit lakestar/run.py): put the repo on the path
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestar.operators import audit, kpi, quality  # noqa: E402
from lakestar.plans.build import CONFORMED_RULES, STAR_TABLES, Warehouse, retire  # noqa: E402
from lakestar.session import scratch_scope, write_and_read  # noqa: E402
from lakestar.sources import csv_io  # noqa: E402


def _parse(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m lakestar.run", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--data", help="folder with the driver tables (<name>.parquet)")
    src.add_argument("--csv", help="datasets folder with source_crm/*.csv and source_erp/*.csv")
    p.add_argument("--as-of", default=None, help="reference date for date checks (YYYY-MM-DD; default: today)")
    p.add_argument("--no-gate", action="store_true", help="report quality errors instead of failing")
    p.add_argument("--collation", default=None, help="collation for string keys and checks, e.g. UTF8_LCASE_RTRIM")
    p.add_argument("--max-rejects", type=int, default=None, help="bad rows that each CSV file may have (default: none)")
    p.add_argument("--resume", action="store_true", help="go on with the newest unpublished run of the same inputs")
    p.add_argument("--keep", type=int, default=None, help="after publishing, remove runs but for the newest ones (and those under a day old)")
    p.add_argument("--metrics-csv", default=None, help="write the 19 audit metrics as one CSV file here")
    p.add_argument("--publish", action="store_true", help="publish the run after a passing gate")
    p.add_argument("--local", action="store_true", help="start a local session (tests, laptops)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = _parse(argv)
    if args.local:
        from lakestar.session import local_session

        spark = local_session()
    else:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("lakestar").getOrCreate()
    as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else _dt.date.today()

    options = {"as_of": as_of, "collation": args.collation}
    if args.csv:
        options["max_rejects"] = args.max_rejects
    make = Warehouse.from_csv if args.csv else Warehouse
    wh = (Warehouse.resume(spark, args.csv or args.data, make=make, **options) if args.resume
          else make(spark, args.csv or args.data, **options)).build()
    if args.csv and args.max_rejects is not None:
        for row in wh.rejects().groupBy("table_name").count().collect():  # one row per table
            print(f"rejected {row['count']} rows of {row.table_name}")
    conformed = {n: wh.conformed(n) for n in CONFORMED_RULES}
    star = {n: wh.star(n) for n in STAR_TABLES}
    reports = {
        "silver": quality.quality_report(quality.conformed_checks(as_of, args.collation), conformed, wh.row_counts()),
        "gold": quality.quality_report(quality.star_checks(args.collation), star, wh.row_counts()),
    }
    status = 0
    with scratch_scope(spark):
        report = write_and_read(quality.tag_layers(reports), "quality-report")  # computed once, printed and gated from here
        for row in report.orderBy("layer", "severity", "check_name").collect():  # one row per check
            print(f"[{row.layer}] {row.severity:7s} {row.check_name}: {row.failed_rows}")
        try:
            quality.quality_gate({layer: report.where(f"layer = '{layer}'").drop("layer") for layer in reports})
        except quality.QualityError as err:
            if not args.no_gate:
                print(err, file=sys.stderr)
                return 1
            status = 2  # gate failed, reported only

    if args.metrics_csv:
        raw = {n: wh.raw(n) for n in CONFORMED_RULES}
        csv_io.write_metrics_csv(audit.audit_metrics(raw, conformed, star), args.metrics_csv)
    if args.publish and status == 0:
        print("published", wh.publish())
        if args.keep:
            print("removed", retire(spark, args.keep))
    kpi.summary(star["fact_sales"]).show(truncate=False)
    print("run folder", wh.run_dir)
    return status


if __name__ == "__main__":
    sys.exit(main())
