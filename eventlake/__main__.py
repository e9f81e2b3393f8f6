"""Jobs for ``spark-submit`` or ``python -m eventlake``: load, build, check.

The exit code is 0 on success, 1 if files failed or alerts were raised.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventlake.operators import quality
from eventlake.plans.pipeline import LEDGER, LakePaths, read, run_pipeline
from eventlake.session import configure
from eventlake.sources import audit


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    parser.add_argument("job", choices=["backfill", "latest", "pipeline", "monitor", "delete", "archive"])
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--landing", help="folder with the hour files")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="UTC time, default now")
    parser.add_argument("--days", type=int, default=7, help="days to backfill")
    parser.add_argument("--look-back", type=int, default=2, help="hours the hourly load looks back")
    parser.add_argument("--keep", type=int, default=90, help="days a load stays in the audit table")
    parser.add_argument("--file", help="hour file to delete")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    configure(spark)
    paths = LakePaths(args.lake)
    raw, history = paths.table("raw_events"), paths.table("load_history")
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job in ("backfill", "latest", "pipeline") and not args.landing:
        raise SystemExit(f"{args.job} needs --landing")

    if args.job == "backfill":
        outcomes = audit.backfill(spark, args.landing, raw, history, as_of, args.days)
        outcomes.groupBy("outcome", "reason").agg(F.count("*").alias("files"), F.sum("row_count").alias("events")).show()
        return int(outcomes.where("outcome = 'failed'").count() > 0)
    if args.job == "latest":
        rows = audit.load_latest(spark, args.landing, raw, history, as_of, args.look_back)
        rows.select("file_name", "status", "row_count", "error_message").show(truncate=False)
        return int(rows.where("status = 'FAILED'").count() > 0)
    if args.job == "pipeline":
        steps = run_pipeline(spark, args.landing, paths, as_of).orderBy("step_no").collect()
        for step in steps:
            print(step.step_no, step.step, step.status, step.row_count)
        return int(any(step.status not in ("done", "pass") for step in steps))
    if args.job == "archive":
        print(f"archived {audit.archive_loads(spark, history, paths.table('load_history_archive'), as_of, args.keep)} loads")
        return 0
    if args.job == "monitor":
        checks = quality.dq_checks(
            read(spark, paths, "raw_events"), read(spark, paths, "fact_events"), read(spark, paths, "load_history"), as_of
        )
        report = quality.dq_report(checks)
        print(json.dumps(report, indent=2, default=str))
        return report["exit_code"]
    if not args.file:
        raise SystemExit("delete needs --file")
    events, rows = audit.delete_file_events(spark, raw, history, args.file, paths.table(LEDGER))
    print(f"deleted {events} events and {rows} audit rows of {args.file}")
    return 0


def main() -> None:
    args = arguments(None)
    sys.exit(run(SparkSession.builder.appName(f"eventlake-{args.job}").getOrCreate(), args))


if __name__ == "__main__":
    main()
