from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finmart import schemas
from finmart.operators import fact
from plans import final_plan_of, plan_of, settings
from rows import account, branch, frame, txn, version

VALID = {**schemas.RAW_TRANSACTIONS, "amount": schemas.MONEY, "fee": schemas.MONEY}


@pytest.fixture
def dims(spark):
    return (
        frame(
            spark,
            schemas.DIM_CUSTOMER,
            version(
                effective_from=date(2026, 4, 1), effective_to=date(2026, 5, 17), is_current=False
            ),
            version(customer_key=2, effective_from=date(2026, 5, 17)),
        ),
        frame(spark, schemas.DIM_ACCOUNT, account(account_key=7)),
        frame(spark, schemas.DIM_BRANCH, branch(branch_key=9)),
    )


def build(spark, dims, *rows):
    return fact.build_fact_transactions(frame(spark, VALID, *rows), *dims)


def test_keys_are_resolved(spark, dims):
    df = build(spark, dims, txn())
    row = df.first()
    assert (row.date_key, row.customer_key, row.account_key, row.branch_key) == (20260405, 1, 7, 9)
    assert (row.txn_id, row.channel) == ("T1", "branch")
    assert dict(df.dtypes) == schemas.FACT_TRANSACTIONS


@pytest.mark.parametrize(
    ("day", "key"),
    [
        ("2026-03-31", None),
        ("2026-04-01", 1),
        ("2026-05-16", 1),
        ("2026-05-17", 2),
        ("2030-01-01", 2),
    ],
)
def test_the_version_in_effect_on_the_day(spark, dims, day, key):
    rows = build(spark, dims, txn(txn_date=day)).collect()
    assert [row.customer_key for row in rows] == [key]


def test_unknown_keys_keep_the_row(spark, dims):
    df = build(
        spark,
        dims,
        txn(account_id="A9"),
        txn(txn_id="T2", branch_code="B9"),
        txn(txn_id="T3", customer_id="C9"),
    )
    assert df.count() == 3
    assert fact.unresolved_keys(df).first().asDict() == {
        "fact_rows": 3,
        "null_date_key": 0,
        "null_customer_key": 1,
        "null_account_key": 1,
        "null_branch_key": 1,
    }


def long_history(spark, n: int):
    """Versions of three days each, with a gap of a day after every hundredth; the last is open."""
    i = F.col("id").cast("int")
    start = F.date_add(F.lit(date(1950, 1, 1)), i * 3)
    end = F.date_sub(F.date_add(start, 3), F.when(i % 100 == 99, 1).otherwise(0))
    filled = {"customer_key": (i + 1), "effective_from": start, "is_current": i == n - 1}
    filled["effective_to"] = F.when(i < n - 1, end)
    return spark.range(n).select(
        *[filled.get(name, F.lit("C1")).cast(kind).alias(name) for name, kind in schemas.DIM_CUSTOMER.items()]
    )


def test_a_long_history_gives_one_row_per_transaction(spark, dims):
    n = 10_000
    dim = long_history(spark, n)
    day = F.date_add(F.lit(date(1949, 12, 20)), (F.col("id") * 11).cast("int"))
    rows = spark.range(2900).select(
        *[
            {"txn_id": F.col("id"), "txn_date": day, "customer_id": F.lit("C1")}.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in VALID.items()
        ]
    )
    df = fact.build_fact_transactions(rows, dim, *dims[1:])
    found = {int(row.txn_id): row.customer_key for row in df.collect()}
    assert len(found) == 2900
    for k, key in found.items():
        since = 11 * k - 12
        version = min(since // 3, n - 1)
        gap = version % 100 == 99 and since % 3 == 2 and version < n - 1
        assert key == (None if since < 0 or gap else version + 1)
    # No join gives more rows than it gets.
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = fact.build_fact_transactions(rows, dim, *dims[1:])._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == 2900
    assert set(join_rows(plan)) == {2900}


def join_rows(node):
    if "Join" in node.nodeName():
        yield node.metrics().get("numOutputRows").get().value()
    children = node.children()
    for k in range(children.size()):
        yield from join_rows(children.apply(k))


def test_overlapping_versions_fail(spark, dims):
    late = version(effective_from=date(2026, 4, 1), effective_to=date(2026, 5, 18), is_current=False)
    open_twice = version(effective_from=date(2026, 4, 1))
    for first in (late, open_twice):
        dim = frame(spark, schemas.DIM_CUSTOMER, first, version(customer_key=2, effective_from=date(2026, 5, 17)))
        with pytest.raises(PySparkException, match="overlap in the history of customer C1"):
            build(spark, (dim, *dims[1:]), txn())


def test_small_dimensions_are_broadcast(spark, sf_dir):
    from finmart.plans import registry

    plan = plan_of(registry.fact_transactions(spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    ("hash_limit", "join"), [("0", "SortMergeJoin"), ("64MB", "ShuffledHashJoin")]
)
def test_a_hot_customer_is_split_when_no_dimension_is_broadcast(spark, dims, hash_limit, join):
    """Half of the rows belong to one customer and one account."""
    i = F.col("id")

    def hot_or_not(prefix):
        return F.when(i % 2 == 0, f"{prefix}1").otherwise(F.concat(F.lit(prefix), i.cast("string")))

    rows = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("T"), i.cast("string")).alias("txn_id"),
        F.lit("2026-04-05").alias("txn_date"),
        hot_or_not("A").alias("account_id"),
        hot_or_not("C").alias("customer_id"),
        F.lit("B1").alias("branch_code"),
        F.lit("atm").alias("channel"),
        F.lit("deposit").alias("txn_type"),
        F.lit(True).alias("is_cash"),
        F.lit(1).cast(schemas.MONEY).alias("amount"),
        F.lit(0).cast(schemas.MONEY).alias("fee"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=hash_limit,
    ):
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        try:
            df = fact.build_fact_transactions(rows, *dims)
            plan = final_plan_of(df)
            assert df.count() == 60_000
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert plan.count(f"{join}(skew=true)") >= 2
