"""The jobs as commands: python -m finmart <job> --lake <path>."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from finmart.plans import jobs
from finmart.plans.reports import CTR_THRESHOLD
from finmart.sources.lake import Lake, write_csv
from finmart.sources.seed import SEED
from finmart.sources.session import (
    UNDECLARED,
    commit_options,
    get_spark_session,
    object_store_options,
    options_for,
)


def _parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--lake", required=True, help="base path of the zones")
    shared.add_argument("--master", help="Spark master; left to spark-submit by default")
    shared.add_argument("--input-gb", type=int, help="size of the feeds, to size the tasks")
    shared.add_argument("--s3-endpoint", help="S3-compatible store; keys go in --option")
    shared.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE", help="Spark setting"
    )

    period = argparse.ArgumentParser(add_help=False)
    default = jobs.Period()
    period.add_argument("--end-date", type=date.fromisoformat, default=default.end)
    period.add_argument("--window-days", type=int, default=default.days)

    snapshots = argparse.ArgumentParser(add_help=False)
    snapshots.add_argument(
        "--snapshot-feeds", nargs="+", default=jobs.SNAPSHOT_FEEDS, metavar="FEED"
    )

    parser = argparse.ArgumentParser(prog="finmart")
    commands = parser.add_subparsers(dest="job", required=True)

    seed = commands.add_parser("seed", parents=[shared, period], help="generate raw feeds")
    seed.add_argument("--customers", type=int, default=2_000)
    seed.add_argument("--accounts", type=int, default=3_000)
    seed.add_argument("--transactions", type=int, default=60_000)
    seed.add_argument("--seed", type=int, default=SEED)

    stage = commands.add_parser(
        "stage", parents=[shared, snapshots], help="gate the raw feeds"
    )
    stage.add_argument("--lenient", action="store_true", help="dates need not be dates")
    stage.add_argument("--corrupt-column", help="reject lines that do not fit the schema")

    load = commands.add_parser(
        "load", parents=[shared, snapshots, period], help="build the star schema"
    )
    load.add_argument("--jdbc-url")
    load.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")

    merge = commands.add_parser(
        "merge", parents=[shared], help="merge one raw customer snapshot into the star schema"
    )
    merge.add_argument("snapshot_feed", metavar="FEED")

    report = commands.add_parser("report", parents=[shared], help="write the reports")
    report.add_argument("--threshold", type=int, default=CTR_THRESHOLD)
    report.add_argument("--first-day", type=date.fromisoformat)
    report.add_argument("--last-day", type=date.fromisoformat)

    query = commands.add_parser("sql", parents=[shared], help="query the star schema")
    query.add_argument("text", help="a SELECT over the five tables")
    query.add_argument("--output", help="write the result there as CSV instead of showing it")
    query.add_argument("--rows", type=int, default=1000, help="rows to show at most")
    return parser


def _pairs(settings: Sequence[str]) -> dict[str, str]:
    return dict(setting.split("=", 1) for setting in settings)


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    on_cluster = not (args.master or "").startswith("local")
    options = commit_options(args.lake)
    if args.input_gb or on_cluster:
        options |= options_for(args.input_gb * 2**30 if args.input_gb else UNDECLARED)
    if args.s3_endpoint:
        options |= object_store_options(args.s3_endpoint)
    spark = get_spark_session(
        f"finmart-{args.job}", {**options, **_pairs(args.option)}, args.master
    )
    lake = Lake(args.lake.rstrip("/"))
    result: object = None
    if args.job == "seed":
        jobs.seed_raw(
            spark,
            lake,
            args.customers,
            args.accounts,
            args.transactions,
            jobs.Period(args.end_date, args.window_days),
            args.seed,
        )
        result = lake.raw("")
    elif args.job == "stage":
        result = jobs.raw_to_staging(
            spark,
            lake,
            args.snapshot_feeds,
            strict_dates=not args.lenient,
            corrupt_column=args.corrupt_column,
        )
    elif args.job == "load":
        result = jobs.staging_to_warehouse(
            spark,
            lake,
            args.snapshot_feeds,
            jobs.Period(args.end_date, args.window_days),
            jdbc_url=args.jdbc_url,
            jdbc_properties=_pairs(args.jdbc_property),
        )
    elif args.job == "merge":
        result = jobs.merge_snapshot(spark, lake, args.snapshot_feed)
    elif args.job == "report":
        result = jobs.regulatory_reports(
            spark, lake, args.threshold, args.first_day, args.last_day
        )
    elif args.job == "sql":
        jobs.register_star(spark, lake)
        rows = spark.sql(args.text)
        if args.output:
            write_csv(rows, args.output)
            result = args.output
        else:
            # Says so itself where there are more rows.
            rows.show(args.rows, truncate=False)
            result = "done"
    print(f"[{args.job}] {result}")
