from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from finmart.operators import dims, keys
from finmart.schemas import DIM_ACCOUNT, DIM_BRANCH, DIM_DATE, RAW_ACCOUNTS, RAW_BRANCHES
from finmart.sources.scratch import materialize
from plans import exchanges, plan_of
from rows import account, branch, frame


def test_calendar(spark):
    calendar = dims.build_dim_date(spark, "2026-01-01", "2026-01-10")
    rows = {row.date: row for row in calendar.collect()}
    assert len(rows) == 10
    assert dict(calendar.dtypes) == DIM_DATE
    new_year = rows[date(2026, 1, 1)]
    assert new_year.date_key == 20260101
    assert (new_year.year, new_year.quarter, new_year.month, new_year.day) == (2026, 1, 1, 1)
    assert new_year.month_name == "January"
    assert rows[date(2026, 1, 3)].is_weekend and rows[date(2026, 1, 4)].day_of_week == 1
    assert not rows[date(2026, 1, 5)].is_weekend


def test_calendar_of_one_day_and_of_none(spark):
    assert dims.build_dim_date(spark, "2026-01-01", date(2026, 1, 1)).count() == 1
    with pytest.raises(ValueError, match="before it starts"):
        dims.build_dim_date(spark, "2026-01-02", "2026-01-01")


def test_branches_are_numbered_by_code(spark):
    feed = frame(spark, RAW_BRANCHES, branch(branch_code="B2"), branch(branch_code="B1"))
    built = dims.build_dim_branch(feed)
    assert dict(built.dtypes) == DIM_BRANCH
    assert {row.branch_code: row.branch_key for row in built.collect()} == {"B1": 1, "B2": 2}


def test_accounts_get_a_key_and_a_date(spark):
    built = dims.build_dim_account(frame(spark, RAW_ACCOUNTS, account(opened_date="2019-07-03")))
    assert dict(built.dtypes) == DIM_ACCOUNT
    assert built.first() == built.first().__class__(**account())


def numbered(df, **options) -> list[tuple]:
    rows = keys.dense_keys(df, ["v"], "k", **options).collect()
    return sorted((row["k"], row["v"]) for row in rows)


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_keys_are_dense_and_ordered(spark, partitions):
    values = [(i * 7919) % 1000 for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(partitions)
    assert numbered(df, start=50) == [(51 + i, i) for i in range(1000)]


def test_keys_of_nothing(spark):
    df = spark.createDataFrame([], "v int")
    assert numbered(df) == []


def test_equal_rows_get_keys_of_their_own_in_many_tasks(spark):
    """A third of the rows are one row; it spans several range partitions."""
    with_copies = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("int").alias("v")
    )
    rows = numbered(with_copies)
    assert [key for key, _ in rows] == list(range(1, 30_001))
    assert [value for _, value in rows] == sorted(value for _, value in rows)
    placed = with_copies.withColumn("_part", F.spark_partition_id()).repartitionByRange(
        4, "v", "_part"
    )
    spread = placed.where("v = 5").select(F.spark_partition_id()).distinct().count()
    assert spread > 1


def test_nulls_come_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    rows = keys.dense_keys(df, ["v"], "k").collect()
    assert {row.v: row.k for row in rows} == {None: 1, 1: 2, 2: 3}


def test_keys_that_do_not_fit(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    with pytest.raises(OverflowError):
        keys.dense_keys(df, ["v"], "k", start=2**31 - 2)


def test_numbering_never_gathers_all_rows_in_one_task(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        keys, "materialize", lambda df, label: seen.append(plan_of(df)) or materialize(df, label)
    )
    dims.build_dim_account(frame(spark, RAW_ACCOUNTS, account(opened_date="2019-07-03")))
    (plan,) = seen
    assert "Window" not in plan and "SinglePartition" not in plan
    assert exchanges(plan) == ["rangepartitioning"]
