"""Run the daily job: spark-submit run_day.py 20240602 --landing LANDING --warehouse WAREHOUSE

A failed check or a missing landing ends it with an error, so a scheduler stops there. Running a day again is safe.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from activitymill.plans.daily import Warehouse, export, run_days


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("first_day", help="20240602 or 2024-06-02")
    parser.add_argument("last_day", nargs="?", help="load all days up to this one at once")
    parser.add_argument("--landing", required=True, help="folder with the hourly files")
    parser.add_argument("--warehouse", required=True, help="folder of the published tables")
    parser.add_argument("--allow-missing-hours", action="store_true", help="go on if an hour is missing or a stub")
    parser.add_argument("--allow-fewer-hours", action="store_true", help="replace a day by one with fewer hours")
    parser.add_argument("--max-bad-share", type=float, default=0.25, help="share of bad lines at which to stop")
    parser.add_argument("--marts-as", choices=["view", "table"], default="view", help="store the marts too")
    parser.add_argument("--database", help="register all tables and marts as lasting views of this database")
    parser.add_argument("--ledger", metavar="FOLDER", help="keep parsed hours there, and parse only new or changed ones")
    parser.add_argument("--verify-hours", action="store_true", help="compare all hours with the ledger by content")
    parser.add_argument("--unique-events", action="store_true", help="stop if an event is stored twice, on any days")
    parser.add_argument("--export", metavar="FORMAT", help="also write all tables through this connector")
    parser.add_argument("--export-to", metavar="FOLDER", help="folder for the export, a path per table")
    args = parser.parse_args()

    spark = (
        SparkSession.builder.appName("daily-activity")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run = run_days(
        spark, args.first_day, args.last_day,
        landing_dir=args.landing, warehouse=args.warehouse, allow_missing_hours=args.allow_missing_hours,
        allow_fewer_hours=args.allow_fewer_hours, max_bad_share=args.max_bad_share, marts_as=args.marts_as,
        database=args.database, ledger=args.ledger, verify_hours=args.verify_hours, unique_events=args.unique_events,
    )
    if args.export:
        export(Warehouse(spark, args.warehouse), args.export, lambda name: {"path": f"{args.export_to}/{name}"})
    print(f"{run.first_day} to {run.last_day}: hours {run.hours}, parsed {len(run.parsed_hours)}, bad lines {run.bad_lines}")
    for check in run.checks:
        print(f"{check.check_name}: {check.failures}")


if __name__ == "__main__":
    main()
