"""``spark-submit`` entry point: ``run`` a report job, print a stored ``report``, or ``sweep`` up after crashed runs.

    spark-submit tallylog/__main__.py run --input hdfs:///logs --store hdfs:///reports \\
        [--batch-size 100000] [--query all|1|2|3] [--prefix NASA_access_log_] [--keep-staging]
    spark-submit tallylog/__main__.py report --store hdfs:///reports --run-id <id>
    spark-submit tallylog/__main__.py sweep --store hdfs:///reports --older-than-hours 24
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tallylog.plans.job import run_report, run_report_job  # noqa: E402
from tallylog.plans.reports import QUERY_CHOICES  # noqa: E402
from tallylog.sources.store import RunNotFound, sweep_crashed_runs  # noqa: E402
from tallylog.sources.text import DEFAULT_PREFIX  # noqa: E402


def _positive(value: str) -> int:
    n = int(value)
    if n <= 0:
        raise argparse.ArgumentTypeError("batch size must be > 0")
    return n


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallylog")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="read, parse, report and store one run")
    run.add_argument("--input", required=True, help="a log file or a folder of them")
    run.add_argument("--store", required=True, help="result store folder")
    run.add_argument("--batch-size", type=_positive, default=None, help="lines per batch; default one per file")
    run.add_argument("--query", choices=sorted(QUERY_CHOICES), default="all")
    run.add_argument("--prefix", default=DEFAULT_PREFIX, help="input file name prefix in a folder")
    run.add_argument("--keep-staging", action="store_true")
    rep = sub.add_parser("report", help="print a stored run")
    rep.add_argument("--store", required=True)
    rep.add_argument("--run-id", required=True)
    sweep = sub.add_parser("sweep", help="drop what crashed runs left, and print their ids")
    sweep.add_argument("--store", required=True)
    sweep.add_argument("--older-than-hours", type=float, required=True, help="younger runs may still be in progress")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tallylog").getOrCreate()
    if args.command == "run":
        run_id = run_report_job(spark, args.input, args.store, batch_size=args.batch_size,
                                query=args.query, name_prefix=args.prefix, keep_staging=args.keep_staging)
        print(run_id)
        return 0
    if args.command == "sweep":
        for run_id in sweep_crashed_runs(spark, args.store, dt.timedelta(hours=args.older_than_hours)):
            print(run_id)
        return 0
    try:
        parts = run_report(spark, args.store, args.run_id)
    except RunNotFound as exc:
        print(exc)
        return 1
    for name in ("runs", "q1", "q2", "q3", "batches"):
        print(f"== {name}")
        print("\t".join(parts[name].columns))
        for row in parts[name].toLocalIterator():  # every row, a partition at a time
            print("\t".join(map(str, row)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
