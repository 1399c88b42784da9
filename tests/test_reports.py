from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from compare import spark_bag
from finmart import schemas
from finmart.operators.dims import build_dim_date
from finmart.plans import analytics, jobs, reports, roles
from plans import final_plan_of, plan_of, settings
from rows import account, booked, branch, frame, version


@pytest.fixture
def star(spark):
    return {
        "customer": frame(
            spark,
            schemas.DIM_CUSTOMER,
            version(is_current=False, segment="private"),
            version(customer_key=2, segment="sme"),
        ),
        "account": frame(
            spark, schemas.DIM_ACCOUNT, account(), account(account_key=2, product_type="current")
        ),
        "branch": frame(
            spark,
            schemas.DIM_BRANCH,
            *[branch(), branch(branch_key=2, branch_code="B2", region="North")],
        ),
        "date": build_dim_date(spark, "2026-04-01", "2026-04-10"),
    }


def facts(spark, *rows):
    return frame(spark, schemas.FACT_TRANSACTIONS, *rows)


def ctr(spark, star, *rows, threshold=2_000_000):
    return reports.ctr_report(
        facts(spark, *rows), star["customer"], star["branch"], star["date"], threshold
    )


def summary(spark, star, *rows):
    return reports.monthly_summary_report(
        facts(spark, *rows), star["branch"], star["account"], star["date"]
    )


def test_ctr_is_large_cash(spark, star):
    rows = ctr(
        spark,
        star,
        booked(amount=3_000_000.0),
        booked(txn_id="T2", amount=1_000.0),
        booked(txn_id="T3", amount=5_000_000.0, is_cash=False),
        booked(txn_id="T4", amount=5_000_000.0, is_cash=None),
        booked(txn_id="T5", amount=2_000_000.0),
        booked(txn_id="T6", amount=1_999_999.99),
    ).collect()
    assert [row.txn_id for row in rows] == ["T1", "T5"]
    assert rows[0].report_month == "2026-04"


def test_ctr_shows_the_version_of_the_day(spark, star):
    rows = ctr(spark, star, booked(amount=3e6), booked(txn_id="T2", customer_key=2, amount=3e6))
    assert [row.segment for row in rows.collect()] == ["private", "sme"]


def test_ctr_keeps_rows_without_context(spark, star):
    rows = ctr(
        spark, star, booked(amount=3e6, date_key=20270101, customer_key=None, branch_key=None)
    ).collect()
    assert len(rows) == 1
    assert rows[0].date is None and rows[0].report_month is None and rows[0].customer_id is None


def test_ctr_order_and_months(spark, star):
    report = ctr(
        spark,
        star,
        booked(txn_id="T2", date_key=20260402, amount=3e6),
        booked(txn_id="T9", date_key=20260401, amount=3e6),
        booked(txn_id="T1", date_key=20260402, amount=3e6),
    )
    assert [row.txn_id for row in report.collect()] == ["T9", "T1", "T2"]
    assert [row.report_month for row in reports.report_months(report).collect()] == ["2026-04"]


def test_summary_counts_and_sums(spark, star):
    rows = summary(
        spark,
        star,
        booked(amount=100.0),
        booked(txn_id="T2", date_key=20260406, amount=200.0),
        booked(txn_id="T3", date_key=20260406, txn_type="payment", amount=50.0),
    ).collect()
    assert {row.txn_type: (row.txn_count, row.total_amount) for row in rows} == {
        "deposit": (2, Decimal(300)),
        "payment": (1, Decimal(50)),
    }


def test_summary_keeps_what_it_cannot_resolve(spark, star):
    rows = summary(
        spark,
        star,
        booked(date_key=20270101),
        booked(txn_id="T2", branch_key=None),
        booked(txn_id="T3", account_key=None),
    ).collect()
    assert sum(row.txn_count for row in rows) == 3
    assert sum(row.report_month is None for row in rows) == 1
    assert sum(row.branch_name is None for row in rows) == 1
    assert sum(row.product_type is None for row in rows) == 1


def test_summary_counts_once_if_an_account_key_repeats(spark, star):
    twice = star["account"].unionByName(star["account"])
    rows = reports.monthly_summary_report(
        facts(spark, booked()), star["branch"], twice, star["date"]
    ).collect()
    assert [row.txn_count for row in rows] == [1]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from finmart.plans import registry

    plan = plan_of(registry.ctr_report(spark, sf_dir))
    fact_scan = next(line for line in plan.splitlines() if "txn_id" in line and "FileScan" in line)
    assert "account_key" not in fact_scan
    assert "EqualTo(is_cash,true), GreaterThanOrEqual(amount,100000.00)" in fact_scan
    assert "SortMergeJoin" not in plan


def test_months_need_no_customer_or_branch(spark, sf_dir):
    from finmart.plans import registry

    plan = plan_of(registry.ctr_months(spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 1
    assert "customer_key" not in plan and "branch_key" not in plan


def test_analytics_sum_before_they_join(spark, sf_dir):
    """The partial sums sit right on the scan, below every join to a text."""
    from finmart.plans import registry

    for name in ("cash_by_branch_month", "top_customers", "weekend_cash"):
        plan = plan_of(registry.QUERIES[name](spark, sf_dir))
        lines = plan.splitlines()
        fact_scan = next(
            i for i, line in enumerate(lines) if "FileScan" in line and "amount#" in line
        )
        below_joins = [line for line in lines[:fact_scan] if "Join" in line or "partial_" in line]
        assert "partial_sum(amount" in below_joins[-1], name


def scanned(plan, column: str):
    """Numbers of the folders that scans with a column have read."""
    if "FileSourceScan" in plan.getClass().getSimpleName() and column in plan.simpleString(200):
        yield plan.metrics().get("numPartitions").get().value()
    children = plan.children()
    for k in range(children.size()):
        yield from scanned(children.apply(k), column)


@pytest.mark.parametrize("name", ["cash_by_branch_month", "weekend_cash", "sql"])
def test_a_filter_on_the_calendar_reads_its_months_only(spark, sf_dir, name):
    lake = roles.warehouse_lake(spark, sf_dir)
    star = jobs.read_star(spark, lake, with_month=True)
    day = star["dim_date"].where("year = 2026 and month = 5")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        if name == "cash_by_branch_month":
            ours = analytics.cash_by_branch_month(star["fact_transactions"], day, star["dim_branch"])
            plain = analytics.cash_by_branch_month(
                roles.warehouse(spark, sf_dir)["fact_transactions"], day, star["dim_branch"]
            )
        else:
            plain = analytics.weekend_cash(roles.warehouse(spark, sf_dir)["fact_transactions"], day)
            ours = analytics.weekend_cash(star["fact_transactions"], day)
        if name == "sql":
            jobs.register_star(spark, lake)
            ours = spark.sql(
                """select is_weekend, count(*) as cash_txn_count, sum(amount) as cash_total_amount
                from fact_transactions join dim_date using (txn_month, date_key)
                where is_cash and year = 2026 and month = 5 group by is_weekend"""
            )
        plan = ours._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        n = plan.execute().count()
    assert list(scanned(plan, "txn_month")) == [1]
    assert n == ours.count() and spark_bag(ours) == spark_bag(plain) and n > 0


def test_summary_splits_a_hot_account(spark, star):
    i = F.col("id")
    fact = spark.range(0, 60_000, 1, 8).select(
        i.cast("string").alias("txn_id"),
        (F.lit(20260401) + i % 9).cast("int").alias("date_key"),
        F.lit(1).alias("customer_key"),
        F.when(i % 2 == 0, 1).otherwise(i).cast("int").alias("account_key"),
        F.lit(1).alias("branch_key"),
        F.md5(i.cast("string")).alias("txn_type"),
        i.cast(schemas.MONEY).alias("amount"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    ):
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        try:
            plan = final_plan_of(
                reports.monthly_summary_report(fact, star["branch"], star["account"], star["date"])
            )
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "ShuffledHashJoin(skew=true)" in plan


@pytest.mark.parametrize("name", ["summary", "mix"])
def test_sums_are_by_product_not_by_account(spark, star, name):
    """Sums by account were nearly as many as rows; now as many as products are moved."""
    i = F.col("id")
    fact = spark.range(0, 4_000, 1, 2).select(
        i.cast("string").alias("txn_id"),
        F.lit(20260401).alias("date_key"),
        (i + 1).cast("int").alias("account_key"),
        F.lit(1).alias("branch_key"),
        F.lit("payment").alias("txn_type"),
        i.cast(schemas.MONEY).alias("amount"),
    )
    accounts = spark.range(1, 4_001).selectExpr(
        "cast(id as int) as account_key", "if(id % 2 = 0, 'term', 'current') as product_type"
    )
    if name == "summary":
        df = reports.monthly_summary_report(fact, star["branch"], accounts, star["date"])
        expected = {("current", 2_000, Decimal("3998000.00")), ("term", 2_000, Decimal("4000000.00"))}
        assert {(r.product_type, r.txn_count, r.total_amount) for r in df.collect()} == expected
    else:
        df = analytics.product_mix_by_region(fact, star["branch"], accounts)
        assert {(r.product_type, r.txn_count, r.avg_amount) for r in df.collect()} == {
            ("current", 2_000, Decimal(1999)),
            ("term", 2_000, Decimal(2000)),
        }
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    sums = [line for line in plan.splitlines() if "Aggregate" in line and "sum(" in line]
    assert sums and not any("account_key" in line for line in sums)


def test_cash_by_branch_month(spark, star):
    rows = analytics.cash_by_branch_month(
        facts(
            spark,
            booked(),
            booked(txn_id="T2", date_key=20260406),
            booked(txn_id="T3", is_cash=False, amount=5.5),
            booked(txn_id="T4", date_key=20270101),
            booked(txn_id="T5", branch_key=None),
        ),
        star["date"],
        star["branch"],
    )
    assert spark_bag(rows) == {
        # branch_name, is_cash, month, total_amount, txn_count, year
        ("Harbour", False, 4, Decimal("5.50"), 1, 2026): 1,
        ("Harbour", True, 4, Decimal(200), 2, 2026): 1,
    }


def test_top_customers_count_current_versions_only(spark, star):
    rows = analytics.top_customers(
        facts(spark, booked(amount=900.0), booked(txn_id="T2", customer_key=2, amount=10.0)),
        star["customer"],
    ).collect()
    assert [(row.customer_id, row.segment, row.total_amount) for row in rows] == [
        ("C1", "sme", Decimal(10))
    ]


def test_top_customers_break_ties_by_id(spark):
    customers = frame(
        spark,
        schemas.DIM_CUSTOMER,
        *[version(customer_key=key, customer_id=f"C{key:02d}") for key in range(1, 16)],
    )
    fact = facts(spark, *[booked(txn_id=f"T{key}", customer_key=key) for key in range(1, 16)])
    top = analytics.top_customers(fact, customers)
    assert [row.customer_id for row in top.collect()] == [f"C{key:02d}" for key in range(1, 11)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_product_mix_mean(spark, star):
    rows = analytics.product_mix_by_region(
        facts(
            spark,
            booked(amount=1.0),
            booked(txn_id="T2", amount=1.0),
            booked(txn_id="T3", amount=2.0),
            booked(txn_id="T4", account_key=2, branch_key=2, amount=7.0),
            booked(txn_id="T5", account_key=None),
        ),
        star["branch"],
        star["account"],
    ).collect()
    assert [(row.region, row.product_type, row.txn_count, row.avg_amount) for row in rows] == [
        ("Coast", "term", 3, Decimal("1.333333")),
        ("North", "current", 1, Decimal(7)),
    ]


def test_weekend_cash(spark, star):
    rows = analytics.weekend_cash(
        facts(
            spark,
            booked(),  # a Sunday
            booked(txn_id="T2", date_key=20260406, amount=1.0),
            booked(txn_id="T3", date_key=20260406, is_cash=False),
            booked(txn_id="T4", is_cash=None),
        ),
        star["date"],
    ).collect()
    assert [tuple(row) for row in rows] == [(False, 1, Decimal(1)), (True, 1, Decimal(100))]
