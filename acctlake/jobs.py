"""Jobs to submit: ``spark-submit acctlake/jobs.py ingest|marts|export ...``.

``ingest``  binary logs into the dataset; prints records and rows per type; exit code 2 if records are missing.
``marts``   reporting tables from the dataset and the mapping CSV; exit code 2 if a data check fails.
``export``  the stored reports as CSV folders.

A cluster must be given a shared scratch folder: ``--conf spark.checkpoint.dir=...``.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from acctlake.plans.ingest import DEFAULT_CUSTOMER, ingest  # noqa: E402
from acctlake.plans.marts import build_marts, read_marts  # noqa: E402
from acctlake.plans.refresh import read_refreshed, read_state, refresh_marts, vacuum_marts  # noqa: E402
from acctlake.plans.reports import REPORTS, export_csv  # noqa: E402
from acctlake.session import build_session  # noqa: E402
from acctlake.sources.compaction import RETENTION, compact, months_present, vacuum  # noqa: E402
from acctlake.sources.dataset import read_type, tables_present  # noqa: E402
from acctlake.sources.seed import read_seed  # noqa: E402

FAILED = 2


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="acctlake", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("ingest", help="binary logs into the dataset")
    job.add_argument("input", help="folder or file of logs")
    job.add_argument("dataset", help="root of the dataset")
    job.add_argument("customer", nargs="?", default=DEFAULT_CUSTOMER)
    job.add_argument("--glob", help="only files of such names")
    job.add_argument("--run-id", help="repeat a failed run under its name")
    job = jobs.add_parser("compact", help="merge the runs of closed months, remove what was merged before")
    job.add_argument("dataset")
    job.add_argument("before", help="first month that is not closed, as 2025-04")
    job.add_argument("--keep-days", type=float, default=RETENTION / 86400, help="days that merged run folders stay for readers")
    job = jobs.add_parser("marts", help="reporting tables from the dataset")
    job.add_argument("dataset")
    job.add_argument("mapping", help="CSV of job_pattern, application, app_group")
    job.add_argument("target", help="folder of the marts")
    job = jobs.add_parser("refresh", help="reporting tables of the months that new runs have touched")
    job.add_argument("dataset")
    job.add_argument("mapping", help="CSV of job_pattern, application, app_group")
    job.add_argument("target", help="folder of the marts by month")
    job.add_argument("--keep-days", type=float, default=RETENTION / 86400, help="days that replaced builds stay for readers")
    job = jobs.add_parser("export", help="reports as CSV")
    job.add_argument("marts", help="folder of the marts")
    job.add_argument("--out", required=True)
    job.add_argument("--only", nargs="+", choices=sorted(REPORTS))
    job.add_argument("--single-file", action="store_true")
    return top


def run(spark: SparkSession, arguments: list[str]) -> int:
    """Run one job; the exit code."""
    args = parser().parse_args(arguments)
    try:
        if args.job == "ingest":
            audit = ingest(spark, args.input, args.dataset, args.customer, run_id=args.run_id, glob=args.glob)
            # One row per type and kind.
            for row in audit.orderBy("table_name").toLocalIterator():
                print(f"{row['table_name']:<16} {row['disposition']:<12} {row['records']:>14} records {row['rows']:>14} rows")
        elif args.job == "compact":
            year, month = map(int, args.before.split("-"))
            for table in sorted(tables_present(args.dataset)):
                merged = compact(spark, args.dataset, table, months_present(spark, args.dataset, table, (year, month)))
                gone = vacuum(spark, args.dataset, table, args.keep_days * 86400)
                print(f"{table:<16} {len(merged):>6} months {sum(merged.values()):>8} runs merged {gone:>8} folders removed")
        elif args.job == "marts":
            built = build_marts(spark, read_type(spark, args.dataset, "smf30"), read_seed(spark, args.mapping), args.target)
            for name in ("dim_application", "fct_job_consumption", "agg_consumption_daily", "rpt_jobs_by_date"):
                print(f"{name:<24} {built[name].agg(F.count(F.lit(1))).first()[0]:>14} rows")
        elif args.job == "refresh":
            months = refresh_marts(spark, args.dataset, read_seed(spark, args.mapping), args.target)
            gone = vacuum_marts(spark, args.target, args.keep_days * 86400)
            print(f"{len(months)} months built {gone} folders removed")
        else:
            by_month = read_state(spark, args.marts).build is not None
            stored = read_refreshed(spark, args.marts) if by_month else read_marts(spark, args.marts)
            written = export_csv(stored, args.out, args.only, single_file=args.single_file)
            for name, rows in written.items():
                print(f"{name:<28} {rows:>14} rows")
    except (RuntimeError, ValueError) as problem:
        print(f"{args.job}: {problem}", file=sys.stderr)
        return FAILED
    return 0


def main() -> int:
    return run(build_session("acctlake"), sys.argv[1:])


if __name__ == "__main__":
    sys.exit(main())
