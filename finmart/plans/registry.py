"""Every operator as a query over the TPC-H-like tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart import schemas
from finmart.operators import dims, fact, keys, quality, scd2
from finmart.plans import analytics, colocated, jobs, reports, roles
from finmart.sources import lake as files
from finmart.sources import seed
from finmart.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

KEY_START = 1000  # of dense_keys, to show the offset
FAULTS_PER_KIND = 60
REPLAY_DAY = date(2026, 6, 15)


def _snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [roles.view(spark, sf_dir, name) for name in ("snap1", "snap2")]


# Quality gate.


def clean_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_transactions(roles.transactions(spark, sf_dir))


def clean_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_transactions(roles.transactions(spark, sf_dir))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_counts(roles.transactions(spark, sf_dir))


def dq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate_totals(roles.transactions(spark, sf_dir))


# Dimensions.


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of all order days."""
    day = F.col("o_orderdate").cast("date")
    first, last = roles.table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    return dims.build_dim_date(spark, first, last)


def dim_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_dim_branch(roles.view(spark, sf_dir, "raw_branches"))


def dim_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_dim_account(roles.view(spark, sf_dir, "raw_accounts"))


def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    numbered = keys.dense_keys(orders, ["o_orderdate", "o_orderkey"], "key", start=KEY_START)
    return numbered.select("o_orderkey", "key")


def scd2_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = schemas.empty(spark, schemas.DIM_CUSTOMER)
    return scd2.scd2_merge(nothing, _snapshots(spark, sf_dir)[0])


def scd2_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_merge(scd2_bootstrap(spark, sf_dir), _snapshots(spark, sf_dir)[1])


def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots, and the second once more at a later date, in one pass."""
    first, second = _snapshots(spark, sf_dir)
    again = second.withColumn("snapshot_date", F.lit(REPLAY_DAY))
    return scd2.scd2_replay([first, second, again])


def scd2_change_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _snapshots(spark, sf_dir)
    return scd2.scd2_change_classes(scd2.scd2_replay([first]), second)


# Fact.


def fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return fact.build_fact_transactions(
        clean_valid(spark, sf_dir),
        star["dim_customer"],
        star["dim_account"],
        star["dim_branch"],
    )


def fact_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.unresolved_keys(roles.warehouse(spark, sf_dir)["fact_transactions"])


# Reports and analytics.


def _for_ctr(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    star = roles.warehouse(spark, sf_dir)
    return tuple(
        star[name] for name in ("fact_transactions", "dim_customer", "dim_branch", "dim_date")
    )


def ctr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ctr_report(*_for_ctr(spark, sf_dir), roles.THRESHOLD)


def ctr_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_months(reports.ctr_hits(*_for_ctr(spark, sf_dir), roles.THRESHOLD))


def monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return reports.monthly_summary_report(
        star["fact_transactions"], star["dim_branch"], star["dim_account"], star["dim_date"]
    )


def cash_by_branch_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return analytics.cash_by_branch_month(
        star["fact_transactions"], star["dim_date"], star["dim_branch"]
    )


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return analytics.top_customers(star["fact_transactions"], star["dim_customer"])


def product_mix_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return analytics.product_mix_by_region(
        star["fact_transactions"], star["dim_branch"], star["dim_account"]
    )


def weekend_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    return analytics.weekend_cash(star["fact_transactions"], star["dim_date"])


# The same over the fact that lies by account.


def _by_account(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    star = roles.warehouse(spark, sf_dir)
    path = scratch_path(spark, "by-account")
    table = path.rpartition("/")[2].replace("-", "_")
    return colocated.write_by_account(star["fact_transactions"], star["dim_account"], path, table)


def colocated_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    stored, accounts = _by_account(spark, sf_dir)
    return reports.monthly_summary_report(
        stored, star["dim_branch"], accounts, star["dim_date"], colocated.ACCOUNT_PART
    )


def colocated_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.warehouse(spark, sf_dir)
    stored, accounts = _by_account(spark, sf_dir)
    return analytics.product_mix_by_region(
        stored, star["dim_branch"], accounts, colocated.ACCOUNT_PART
    )


# Sources and sinks: what was written is what is read.


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(roles.transactions(spark, sf_dir), path)
    return quality.as_money(files.read_csv(spark, path, schemas.RAW_TRANSACTIONS))


def gate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the gate, written in one go; valid rows have no reason."""
    path = scratch_path(spark, "gate")
    as_sent = roles.transactions(spark, sf_dir).withColumns(
        {name: F.col(name).cast("double") for name in ("amount", "fee")}
    )
    files.write_gate(*quality.split_transactions(as_sent), f"{path}/valid", f"{path}/rejects")
    valid = files.read_valid(spark, f"{path}/valid")
    rejects = quality.as_money(files.read_rejects(spark, f"{path}/rejects"))
    return valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejects)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the warehouse stores it."""
    path = scratch_path(spark, "fact")
    files.write_fact(fact_transactions(spark, sf_dir), path)
    return files.read_fact(spark, path)


def fact_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the stored fact between two days, without reading the rest."""
    lake = roles.warehouse_lake(spark, sf_dir)
    return jobs.read_star(spark, lake, date(2026, 5, 20), date(2026, 6, 10))["fact_transactions"]


def _read_ctr(spark: SparkSession, path: str) -> DataFrame:
    return files.read_partitioned_csv(spark, path, schemas.CTR_REPORT, "report_month")


def ctr_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ctr")
    hits = reports.ctr_hits(*_for_ctr(spark, sf_dir), roles.THRESHOLD)
    files.write_partitioned_csv(hits, path, "report_month")
    return _read_ctr(spark, path)


def ctr_month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ctr")
    hits = reports.ctr_hits(*_for_ctr(spark, sf_dir), roles.THRESHOLD)
    files.write_report(hits, path, "report_month", ["date", "txn_id"])
    return _read_ctr(spark, path)


# Generated feeds, one record per row of a given table.


def _rows(spark: SparkSession, sf_dir: str, table: str, key: str) -> DataFrame:
    return roles.table(spark, sf_dir, table).select((F.col(key) + 1).alias("row"))


def seed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _rows(spark, sf_dir, "customer", "c_custkey")
    return seed.generate_customers(ids, roles.PERIOD.start)


def seed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed.apply_customer_drift(
        seed_customers(spark, sf_dir), roles.PERIOD.second_snapshot
    )


def seed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _rows(spark, sf_dir, "part", "p_partkey")
    customers = roles.table(spark, sf_dir, "customer").count()
    return seed.generate_accounts(ids, customers, roles.PERIOD.start)


def seed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed.generate_transactions(
        _rows(spark, sf_dir, "orders", "o_orderkey"),
        roles.table(spark, sf_dir, "part").count(),
        roles.table(spark, sf_dir, "customer").count(),
        seed.branch_codes(),
        roles.PERIOD.start,
        roles.PERIOD.days,
    )


def seed_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated feed with faults in it."""
    orders = roles.table(spark, sf_dir, "orders").count()
    return seed.inject_dirty_rows(
        seed_transactions(spark, sf_dir), orders + 1, FAULTS_PER_KIND
    )


def seed_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate finds in that feed."""
    return quality.reject_counts(seed_faults(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        clean_valid,
        clean_rejected,
        reject_counts,
        dq_totals,
        dim_date,
        dim_branch,
        dim_account,
        dense_keys,
        scd2_bootstrap,
        scd2_merged,
        scd2_replay,
        scd2_change_classes,
        fact_transactions,
        fact_unresolved,
        ctr_report,
        ctr_months,
        monthly_summary,
        cash_by_branch_month,
        top_customers,
        product_mix_by_region,
        weekend_cash,
        colocated_summary,
        colocated_mix,
        csv_roundtrip,
        gate_roundtrip,
        parquet_roundtrip,
        fact_period,
        ctr_partitioned_roundtrip,
        ctr_month_files,
        seed_customers,
        seed_drift,
        seed_accounts,
        seed_transactions,
        seed_faults,
        seed_reject_counts,
    )
}
