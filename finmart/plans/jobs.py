"""The jobs: seed -> staging -> warehouse (load all, or merge a snapshot) -> reports.

Storage is the only hand-over between jobs, and within a job a table is written
once and read back, never computed twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finmart import schemas
from finmart.operators import quality
from finmart.operators.dims import (
    build_dim_account,
    build_dim_branch,
    build_dim_date,
    check_unique,
    with_month as calendar_with_month,
)
from finmart.operators.fact import build_fact_transactions, check_fact, fact_counts
from finmart.operators.scd2 import check_snapshot, scd2_merge, scd2_replay
from finmart.plans.reports import CTR_THRESHOLD, ctr_hits, monthly_summary_report
from finmart.sources import lake as files
from finmart.sources import seed, versions
from finmart.sources.jdbc import load_star
from finmart.sources.lake import Lake
from finmart.sources.scratch import materialize
from finmart.sources.versions import Version

SNAPSHOT_FEEDS = ("customers_snapshot1", "customers_snapshot2")

DIMENSIONS = {
    "dim_date": schemas.DIM_DATE,
    "dim_branch": schemas.DIM_BRANCH,
    "dim_account": schemas.DIM_ACCOUNT,
    "dim_customer": schemas.DIM_CUSTOMER,
}


@dataclass(frozen=True)
class Period:
    """The days the feeds cover, and the day of the second snapshot."""

    end: date = date(2026, 6, 30)
    days: int = 90

    @property
    def start(self) -> date:
        return self.end - timedelta(days=self.days - 1)

    @property
    def second_snapshot(self) -> date:
        return self.start + timedelta(days=45)


def seed_raw(
    spark: SparkSession,
    lake: Lake,
    customers: int = 2_000,
    accounts: int = 3_000,
    transactions: int = 60_000,
    period: Period = Period(),
    random_seed: int = seed.SEED,
) -> None:
    """Fill the raw zone with generated feeds."""
    first = seed.generate_customers(seed.rows(spark, customers), period.start, random_seed)
    clean = seed.generate_transactions(
        seed.rows(spark, transactions),
        accounts,
        customers,
        seed.branch_codes(),
        period.start,
        period.days,
        random_seed,
    )
    feeds = {
        "branches": seed.generate_branches(spark),
        "accounts": seed.generate_accounts(
            seed.rows(spark, accounts), customers, period.start, random_seed
        ),
        "customers_snapshot1": first,
        "customers_snapshot2": seed.apply_customer_drift(
            first, period.second_snapshot, seed=random_seed
        ),
        "transactions": seed.inject_dirty_rows(clean, transactions + 1, seed=random_seed),
    }
    for feed, df in feeds.items():
        files.write_csv(df, lake.raw(feed))


def _stage(spark: SparkSession, lake: Lake, feed: str, contract: dict[str, str]) -> None:
    files.write_parquet(files.read_csv(spark, lake.raw(feed), contract), lake.staging(feed))


def _staged_snapshot(spark: SparkSession, lake: Lake, feed: str) -> DataFrame:
    staged = files.read_parquet(spark, lake.staging(feed), schemas.RAW_CUSTOMERS)
    return staged.withColumn("snapshot_date", F.to_date("snapshot_date"))


def raw_to_staging(
    spark: SparkSession,
    lake: Lake,
    snapshot_feeds: Sequence[str] = SNAPSHOT_FEEDS,
    strict_dates: bool = True,
    corrupt_column: str | None = None,
) -> dict[str, int]:
    """Gate the transactions, pass the reference data through; returns the counts.

    The counts are observed while the gate's output is written.
    """
    contracts = {
        "branches": schemas.RAW_BRANCHES,
        "accounts": schemas.RAW_ACCOUNTS,
        **dict.fromkeys(snapshot_feeds, schemas.RAW_CUSTOMERS),
    }
    for feed, contract in contracts.items():
        _stage(spark, lake, feed, contract)

    # Parsed once: what the gate looks at several times is Parquet.
    raw = materialize(
        files.read_csv(
            spark, lake.raw("transactions"), schemas.RAW_TRANSACTIONS, corrupt_column
        ),
        "raw-transactions",
    )
    valid, rejected = quality.split_transactions(
        raw, strict_dates=strict_dates, corrupt_column=corrupt_column
    )
    passed, refused = Observation("valid"), Observation("rejected")
    reason = F.col("reject_reason")
    files.write_gate(
        valid.observe(passed, F.count("*").alias("valid")),
        rejected.observe(
            refused,
            F.count("*").alias("rejected"),
            *[F.count_if(reason == name).alias(name) for name in quality.REASONS],
        ),
        lake.staging("transactions"),
        lake.rejects,
    )
    counts = {**passed.get, **refused.get}
    return {"total": counts["valid"] + counts["rejected"], **counts}


def write_star(
    spark: SparkSession,
    lake: Lake,
    branches: DataFrame,
    accounts: DataFrame,
    snapshots: Sequence[DataFrame],
    valid: DataFrame,
    period: Period,
) -> dict[str, DataFrame]:
    """Check the feeds, then build, write and publish the five tables; returns them.

    A feed that would multiply fact rows or break the history fails here, and so does a
    fact that does not agree with the valid rows: the version before stays the current one.
    """
    check_unique(accounts, "account_id")
    check_unique(branches, "branch_code")
    check_snapshot(
        reduce(DataFrame.unionByName, [s.select(*schemas.RAW_CUSTOMERS) for s in snapshots]),
        once_per=("customer_id", "snapshot_date"),
    )
    dimensions = {
        "dim_date": build_dim_date(spark, period.start, period.end),
        "dim_branch": build_dim_branch(branches),
        "dim_account": build_dim_account(accounts),
        "dim_customer": scd2_replay(snapshots),
    }
    version = versions.current(spark, lake).following()
    for name, df in dimensions.items():
        version.tables[name] = version.folder(name)
        files.write_parquet(df, lake.warehouse(version.tables[name]))
    _write_fact(spark, lake, version, valid)
    versions.publish(spark, lake, version)
    return read_star(spark, lake)


def _write_fact(spark: SparkSession, lake: Lake, version: Version, valid: DataFrame) -> None:
    """Write the fact of a version whose dimensions are written, and check it."""
    star = _read_dimensions(spark, lake, version)
    dimensions = {
        name: star[f"dim_{name.removesuffix('_key')}"]
        for name in ("customer_key", "account_key", "branch_key")
    }
    seen = Observation("valid")
    folder = version.folder("fact_transactions")
    files.write_fact(
        build_fact_transactions(
            valid.observe(seen, F.count("*").alias("rows")), *dimensions.values()
        ),
        lake.warehouse(folder),
    )
    months = fact_counts(files.read_fact_files(spark, lake.warehouse(folder)), "txn_month")
    n_valid = seen.get["rows"]
    if n_valid != sum(row.n for row in months):
        n_valid = valid.count()  # tasks that ran twice are observed twice
    check_fact(months, n_valid, dimensions)
    version.fact.update({row.txn_month: folder for row in months})


def merge_snapshot(spark: SparkSession, lake: Lake, snapshot_feed: str) -> dict[str, int]:
    """Merge one raw customer snapshot into the stored history; returns the row counts.

    The customers' versions of the days before stay as they are, and so do the fact's
    months before the snapshot's; the later months are built again from the valid rows.
    The outcome is that of a load of all snapshots.
    """
    stored = versions.current(spark, lake)
    if not stored.number:
        raise ValueError("there is no warehouse to merge into: load one first")
    _stage(spark, lake, snapshot_feed, schemas.RAW_CUSTOMERS)
    incoming = _staged_snapshot(spark, lake, snapshot_feed)
    first = incoming.agg(F.min("snapshot_date")).first()[0]

    version = stored.following()
    version.tables.update(stored.tables)
    version.tables["dim_customer"] = version.folder("dim_customer")
    history = _read_dimensions(spark, lake, stored)["dim_customer"]
    files.write_parquet(
        scd2_merge(history, incoming), lake.warehouse(version.tables["dim_customer"])
    )
    version.fact.update(stored.fact)
    if first:
        since = first.replace(day=1)
        for month in stored.fact:
            if month is not None and month >= since.year * 100 + since.month:
                del version.fact[month]
        valid = files.read_valid(spark, lake.staging("transactions"))
        _write_fact(
            spark, lake, version, valid.where(F.col("txn_date").try_cast("date") >= F.lit(since))
        )
    versions.publish(spark, lake, version)
    return _row_counts(read_star(spark, lake))


def _read_dimensions(spark: SparkSession, lake: Lake, version: Version) -> dict[str, DataFrame]:
    return {
        name: files.read_parquet(spark, lake.warehouse(version.tables[name]), contract)
        for name, contract in DIMENSIONS.items()
    }


def read_star(
    spark: SparkSession,
    lake: Lake,
    first: date | None = None,
    last: date | None = None,
    with_month: bool = False,
) -> dict[str, DataFrame]:
    """The published tables; the fact between two days, if given, and with the month of
    each row's folder, if asked for.

    What is read stays the version of this moment, whatever is published later.
    """
    version = versions.current(spark, lake)
    if not version.number:
        raise ValueError(f"no warehouse has been published below {lake.base}")
    folders: dict[str, list[int | None]] = {}
    for month, folder in version.fact.items():
        folders.setdefault(folder, []).append(month)
    parts = [
        # A folder may have months that a later version has taken over.
        files.read_fact(
            spark,
            lake.warehouse(folder),
            first,
            last,
            months if len(folders) > 1 else None,
            with_month,
        )
        for folder, months in folders.items()
    ]
    contract = schemas.FACT_TRANSACTIONS | ({schemas.FACT_MONTH: "int"} if with_month else {})
    fact = reduce(DataFrame.unionByName, parts) if parts else schemas.empty(spark, contract)
    return {**_read_dimensions(spark, lake, version), "fact_transactions": fact}


def _row_counts(star: Mapping[str, DataFrame]) -> dict[str, int]:
    # Counts of written Parquet come from the file footers.
    return {name: df.count() for name, df in star.items()}


def register_star(spark: SparkSession, lake: Lake) -> list[str]:
    """Make the written tables known to SQL under their names; returns the names.

    The fact and the calendar also have `txn_month`: joined by it and the day, a filter
    on the calendar says which folders of the fact are read.
    """
    star = read_star(spark, lake, with_month=True)
    star["dim_date"] = calendar_with_month(star["dim_date"])
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    return list(star)


def staging_to_warehouse(
    spark: SparkSession,
    lake: Lake,
    snapshot_feeds: Sequence[str] = SNAPSHOT_FEEDS,
    period: Period = Period(),
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Build the star schema and, given a URL, load it into a database; returns the
    row counts."""

    def staged(feed: str, contract: dict[str, str]) -> DataFrame:
        return files.read_parquet(spark, lake.staging(feed), contract)

    valid = files.read_valid(spark, lake.staging("transactions"))
    star = write_star(
        spark,
        lake,
        staged("branches", schemas.RAW_BRANCHES),
        staged("accounts", schemas.RAW_ACCOUNTS),
        [_staged_snapshot(spark, lake, feed) for feed in snapshot_feeds],
        valid,
        period,
    )
    counts = _row_counts(star)
    if jdbc_url:
        load_star(star, jdbc_url, properties=jdbc_properties)
    return counts


def regulatory_reports(
    spark: SparkSession,
    lake: Lake,
    threshold: int = CTR_THRESHOLD,
    first: date | None = None,
    last: date | None = None,
) -> dict[str, int]:
    """Write both reports as CSV, a folder per month, and the whole summary as one file;
    returns the row counts of what was reported.

    Given a first or last day, the months it lies in and those between are reported, whole,
    and the folders of other months stay as they are.
    """
    months = None
    if first or last:
        calendar = read_star(spark, lake)["dim_date"].agg(F.min("date"), F.max("date")).first()
        first, last = (first or calendar[0]).replace(day=1), _month_end(last or calendar[1])
        months = _months(first, last)
    star = read_star(spark, lake, first, last)
    fact, branch, day = (star[n] for n in ("fact_transactions", "dim_branch", "dim_date"))
    month = "report_month"
    hits = files.write_report(
        ctr_hits(fact, star["dim_customer"], branch, day, threshold),
        lake.report("ctr"),
        month,
        ["date", "txn_id"],
        months,
    )
    path = lake.report("monthly_summary")
    order = list(schemas.MONTHLY_SUMMARY)[1:5]
    summary = monthly_summary_report(fact, branch, star["dim_account"], day)
    groups = files.write_report(summary, path, month, order, months)
    whole = files.read_partitioned_csv(spark, path, schemas.MONTHLY_SUMMARY, month)
    files.write_one_csv(
        whole.coalesce(1).sortWithinPartitions(month, *order), lake.report("monthly_summary_file")
    )
    return {"ctr": hits, "monthly_summary": groups}


def _month_end(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=31)).replace(day=1) - timedelta(days=1)


def _months(first: date, last: date) -> list[str]:
    """The months of all days between two, both included, as 2026-04."""
    days = ((first + timedelta(days=n)) for n in range((last - first).days + 1))
    return sorted({f"{day:%Y-%m}" for day in days})
