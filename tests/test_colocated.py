"""The fact that lies by account."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from finmart import schemas
from finmart.operators.dims import build_dim_date
from finmart.plans import analytics, colocated, reports
from finmart.sources.scratch import scratch_path
from plans import final_plan_of, settings

BUCKETS = 8
NO_BROADCAST = {
    "spark__sql__shuffle__partitions": str(BUCKETS),
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def star(spark):
    """Two fifths of the rows are of account 1, a tenth has none, and a tenth one that is unknown."""
    i = F.col("id")
    account = F.when(i % 5 < 2, 1).when(i % 10 == 4, F.lit(None)).when(i % 10 == 9, 5000).otherwise(i % 300 + 2)
    fact = spark.range(0, 30_000, 1, 6).select(
        F.concat(F.lit("T"), i.cast("string")).alias("txn_id"),
        F.when(i % 97 != 0, 20260401 + i % 30 + 100 * (i % 2)).cast("int").alias("date_key"),
        F.lit(1).alias("customer_key"),
        account.cast("int").alias("account_key"),
        (i % 3 + 1).cast("int").alias("branch_key"),
        F.lit("atm").alias("channel"),
        F.when(i % 2 == 0, "deposit").otherwise("payment").alias("txn_type"),
        F.lit(True).alias("is_cash"),
        (i % 1000).cast(schemas.MONEY).alias("amount"),
        F.lit(0).cast(schemas.MONEY).alias("fee"),
    )
    k = F.col("id").cast("int")
    accounts = spark.range(1, 400).select(k.alias("account_key"), F.concat(F.lit("p"), k % 4).alias("product_type"))
    branches = spark.range(1, 4).select(
        k.alias("branch_key"),
        *[F.concat(F.lit(name), k).alias(name) for name in ("branch_code", "branch_name", "province", "region")],
    )
    return fact, accounts, branches, build_dim_date(spark, date(2026, 4, 1), date(2026, 5, 31))


@pytest.fixture(scope="module")
def laid(spark, star):
    path = scratch_path(spark, "by-account")
    stored, accounts = colocated.write_by_account(star[0], star[1], path, "laid_by_account", BUCKETS)
    return path, stored, accounts


def rows_of(df):
    return sorted(map(str, df.collect()))


def fact_side(plan):
    """The part of a plan above the scan of the stored fact, up to the join with accounts."""
    lines = plan.splitlines()
    scan = next(n for n, line in enumerate(lines) if "Scan parquet" in line and "laid_by_account" in line)
    join = max(n for n in range(scan) if "Join" in lines[n])
    return "\n".join(lines[join : scan + 1])


def test_hot_accounts_have_parts_of_bounded_size(star):
    parts = {r.account_key: r.parts for r in colocated.hot_accounts(star[0], BUCKETS).collect()}
    share = -(-30_000 // (4 * BUCKETS))
    assert parts == {1: -(-12_000 // share), None: -(-3_000 // share), 5000: -(-3_000 // share)}


def test_layout_keeps_the_rows(star, laid):
    assert rows_of(laid[1].select(*schemas.FACT_TRANSACTIONS)) == rows_of(star[0])


def test_no_bucket_has_the_hot_account(laid):
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    bucket = F.regexp_extract(name, r"_(\d{5})\.", 1)
    sizes = [r[1] for r in laid[1].groupBy(bucket).count().collect()]
    assert len(sizes) == BUCKETS
    assert max(sizes) < 12_000


def test_accounts_meet_their_parts(star, laid):
    found = {r.account_key: r.n for r in laid[2].groupBy("account_key").agg(F.count("*").alias("n")).collect()}
    assert len(found) == star[1].count()
    assert found[1] > 1 and set(found.values()) == {1, found[1]}


def test_summary_and_mix_are_those_of_the_plain_fact(spark, star, laid):
    fact, accounts, branches, days = star
    _, stored, with_parts = laid
    by = colocated.ACCOUNT_PART
    assert rows_of(reports.monthly_summary_report(stored, branches, with_parts, days, by)) == rows_of(
        reports.monthly_summary_report(fact, branches, accounts, days)
    )
    assert rows_of(analytics.product_mix_by_region(stored, branches, with_parts, by)) == rows_of(
        analytics.product_mix_by_region(fact, branches, accounts)
    )


@pytest.mark.parametrize("name", ["summary", "mix", "join"])
def test_the_fact_is_not_moved_to_meet_accounts(spark, star, laid, name):
    _, _, branches, days = star
    _, stored, accounts = laid
    by = colocated.ACCOUNT_PART
    with settings(spark, **NO_BROADCAST):
        if name == "summary":
            df = reports.monthly_summary_report(stored, branches, accounts, days, by)
        elif name == "mix":
            df = analytics.product_mix_by_region(stored, branches, accounts, by)
        else:
            df = stored.join(accounts, list(by)).select("txn_id", "product_type", "amount")
        side = fact_side(final_plan_of(df))
    assert "SortMergeJoin" in side or "ShuffledHashJoin" in side
    assert "Exchange" not in side and "ShuffleQueryStage" not in side


def test_another_session_reads_the_months_it_needs(spark, laid):
    path, stored, _ = laid
    read = colocated.read_by_account(spark, path, "read_by_account", BUCKETS)
    assert rows_of(read) == rows_of(stored)
    april = read.where("txn_month = 202604")
    assert april.count() == stored.where("txn_month = 202604").count() > 0
    files = {re.search(r"txn_month=(\w+)", file)[1] for file in april.inputFiles()}
    assert files == {"202604"}


def test_no_rows(spark, star):
    fact, accounts, branches, days = star
    nothing = schemas.empty(spark, schemas.FACT_TRANSACTIONS)
    path = scratch_path(spark, "by-account")
    stored, with_parts = colocated.write_by_account(nothing, accounts, path, "nothing_by_account", BUCKETS)
    assert with_parts.count() == accounts.count()
    by = colocated.ACCOUNT_PART
    assert reports.monthly_summary_report(stored, branches, with_parts, days, by).count() == 0
