from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from compare import spark_bag
from finmart.operators import quality
from finmart.schemas import RAW_TRANSACTIONS
from finmart.sources.scratch import materialize
from plans import exchanges, plan_of, settings
from rows import frame, txn


def raw(spark, *rows):
    return frame(spark, RAW_TRANSACTIONS, *rows)


def reasons(df) -> Counter:
    return Counter(row.reject_reason for row in quality.rejected_transactions(df).collect())


def gate(df, **options) -> dict[str, str | None]:
    tagged = quality.tag_transactions(df, **options).collect()
    assert len(tagged) == df.count()
    return {row.txn_id: row.reject_reason for row in tagged}


def test_distinct_good_rows_are_valid(spark):
    df = raw(spark, txn(), txn(txn_id="T2"))
    assert quality.valid_transactions(df).count() == 2
    assert reasons(df) == {}


@pytest.mark.parametrize("field", quality.REQUIRED)
def test_missing_required_field(spark, field):
    df = raw(spark, txn(txn_id="T0"), txn(**{field: None}))
    assert reasons(df) == {"null_required_field": 1}
    assert quality.valid_transactions(df).count() == 1


@pytest.mark.parametrize("field", ["channel", "txn_type", "is_cash", "fee"])
def test_other_fields_may_be_missing(spark, field):
    assert quality.valid_transactions(raw(spark, txn(**{field: None}))).count() == 1


def test_negative_amount(spark):
    assert reasons(raw(spark, txn(txn_id="T0"), txn(amount=-50.0))) == {"negative_amount": 1}


def test_zero_amount_is_valid_and_a_rounded_off_minus_is_not(spark):
    assert gate(raw(spark, txn(amount=0.0), txn(txn_id="T2", amount=-0.004))) == {
        "T1": None,
        "T2": "negative_amount",
    }


def test_the_null_rule_comes_first(spark):
    assert gate(raw(spark, txn(customer_id=None, amount=-1.0))) == {"T1": "null_required_field"}


def test_one_copy_survives(spark):
    df = raw(spark, txn(), txn(), txn(), txn(txn_id="T2"))
    assert reasons(df) == {"duplicate_txn_id": 2}
    assert sorted(row.txn_id for row in quality.valid_transactions(df).collect()) == ["T1", "T2"]


def test_a_bad_first_copy_does_not_shadow_a_good_one(spark):
    df = raw(spark, txn(amount=-1.0, txn_date="2026-04-01"), txn(txn_date="2026-04-09"))
    assert reasons(df) == {"negative_amount": 1}
    assert quality.valid_transactions(df).first().txn_date == "2026-04-09"


def test_the_caller_says_which_copy_survives(spark):
    df = raw(spark, txn(txn_date="2026-04-02", amount=9.0), txn(txn_date="2026-04-01", amount=10.0))
    by_date = quality.valid_transactions(df).first()
    by_amount = quality.valid_transactions(df, tie_break=["amount"]).first()
    assert (by_date.txn_date, by_amount.txn_date) == ("2026-04-01", "2026-04-02")


def test_money_and_date_rules(spark):
    df = raw(
        spark,
        txn(amount=float("nan")),
        txn(txn_id="T2", amount=1e14),
        txn(txn_id="T3", fee=float("inf")),
        txn(txn_id="T4", txn_date="2026-02-30"),
        txn(txn_id="T5", amount=9999999999999.99),
    )
    assert gate(df) == {
        "T1": "invalid_amount",
        "T2": "invalid_amount",
        "T3": "invalid_amount",
        "T4": "invalid_txn_date",
        "T5": None,
    }
    # Only the date rule is optional: money without an exact value never passes.
    lenient = gate(df, strict_dates=False)
    assert lenient == {**gate(df), "T4": None}
    valid = quality.valid_transactions(df, strict_dates=False)
    assert {row.txn_id: row.amount is None for row in valid.collect()} == {"T4": False, "T5": False}


def test_money_is_decimal_in_valid_rows_and_as_sent_in_rejects(spark):
    df = raw(spark, txn(amount=10.005, fee=0.1), txn(txn_id="T2", amount=-0.004))
    row = quality.valid_transactions(df).first()
    assert (row.amount, row.fee) == (Decimal("10.01"), Decimal("0.10"))
    assert quality.rejected_transactions(df).first().amount == -0.004


def test_corrupt_lines(spark):
    df = raw(spark, txn(), txn(txn_id="T2")).withColumn(
        "_line", F.when(F.col("txn_id") == "T2", "T2,x")
    )
    assert gate(df, corrupt_column="_line") == {"T1": None, "T2": "malformed_row"}
    valid = quality.valid_transactions(df, corrupt_column="_line")
    assert valid.columns == list(RAW_TRANSACTIONS) and valid.count() == 1


def hot_feed(spark, n: int, partitions: int):
    """Rows of which a third share an id, a third are copies of one row, and the
    others are a mixture of unique, faulty and twofold ones."""
    i = F.col("id")
    return spark.range(0, n, 1, partitions).select(
        F.when(i % 3 == 0, "HOT").when(i % 3 == 1, "COPY").otherwise(
            F.concat(F.lit("T"), F.floor(i / 6).cast("string"))
        ).alias("txn_id"),
        F.lit("2026-04-05").alias("txn_date"),
        F.when(i % 33 != 5, "A1").alias("account_id"),
        F.lit("C1").alias("customer_id"),
        F.lit("B1").alias("branch_code"),
        F.lit("atm").alias("channel"),
        F.lit("deposit").alias("txn_type"),
        F.lit(True).alias("is_cash"),
        F.when(i % 3 == 1, 5.0)
        .when(i % 99 == 8, -1.0)
        .otherwise(i.cast("double") + 1)
        .alias("amount"),
        F.lit(0.0).alias("fee"),
    )


def test_both_ways_to_valid_rows_agree(spark):
    df = hot_feed(spark, 6000, 7)
    tagged = quality.tag_transactions(df).where("reject_reason is null").drop("reject_reason")
    valid = quality.valid_transactions(df)
    assert spark_bag(quality.as_money(tagged)) == spark_bag(valid)
    ids = [row.txn_id for row in valid.select("txn_id").collect()]
    assert len(ids) == len(set(ids))
    assert valid.where("txn_id = 'HOT'").first().amount == 1


@pytest.mark.parametrize("partitions", [1, 17])
def test_outcome_does_not_depend_on_the_layout(spark, partitions):
    df = hot_feed(spark, 3000, 5)
    moved = df.repartition(partitions)
    assert spark_bag(quality.tag_transactions(moved)) == spark_bag(quality.tag_transactions(df))


def test_counts_agree_with_the_gate(spark):
    df = hot_feed(spark, 6000, 7)
    counted = {row.reject_reason: row.n for row in quality.reject_counts(df).collect()}
    assert counted == reasons(df)
    totals = quality.gate_totals(df).first()
    assert (totals.total, totals.rejected) == (6000, sum(counted.values()))
    assert totals.valid + totals.rejected == totals.total


def test_an_empty_feed(spark):
    df = raw(spark)
    assert quality.reject_counts(df).collect() == []
    assert tuple(quality.gate_totals(df).first()) == (0, 0, 0)
    assert quality.tag_transactions(df).collect() == []


def test_valid_rows_fold_copies_before_the_shuffle(spark):
    plan = plan_of(quality.valid_transactions(hot_feed(spark, 100, 2)))
    assert "row_number(), 1, Partial" in plan
    assert exchanges(plan) == ["hashpartitioning"]


def test_no_task_of_the_ranking_holds_a_hot_id(spark):
    """All partitions of both shuffles stay near the mean although two thirds of the
    rows share two ids."""
    with settings(spark, spark__sql__adaptive__enabled="false"):
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        try:
            tagged = quality.tag_transactions(hot_feed(spark, 64_000, 64))
            per_task = tagged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
            sizes = [row.n for row in per_task.collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 64_000
    assert max(sizes) < 2.5 * 64_000 / 16


def test_only_contenders_are_moved(spark):
    """Rows whose id no other row has are not shuffled, and neither are rule rejects."""
    unique = F.concat(F.lit("U"), F.monotonically_increasing_id().cast("string"))
    feed = hot_feed(spark, 64_000, 8).where("amount > 0").withColumn("txn_id", unique)
    feed = materialize(feed.withColumn("txn_id", F.when(F.col("amount") < 180, "SAME").otherwise(unique)), "feed")
    n_same = feed.where("txn_id = 'SAME' and account_id is not null").count()
    assert 30 < n_same < 25_000
    with settings(spark, spark__sql__adaptive__enabled="false"):
        for moved in (
            quality.tag_transactions(feed),
            *quality.split_transactions(feed),
        ):
            counted = list(shuffled_rows(moved))
            assert sum(counted) <= 2 * n_same, counted
    settled, contenders = quality._parted(feed, True, None)
    assert settled.count() + contenders.count() == feed.count()
    assert "Exchange" not in plan_of(settled)


def shuffled_rows(df):
    """How many rows each shuffle of a plan has written."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()

    def walk(node):
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            yield metrics.get("shuffleRecordsWritten").get().value()
        children = node.children()
        for k in range(children.size()):
            yield from walk(children.apply(k))

    yield from walk(plan)


def test_a_full_filter_only_moves_more(spark, monkeypatch):
    df = hot_feed(spark, 3000, 5)
    expected = spark_bag(quality.tag_transactions(df))
    monkeypatch.setattr(quality, "_FILTER_BITS", 64)
    assert spark_bag(quality.tag_transactions(df)) == expected
    assert quality._parted(df, True, None)[1].count() > 2000


def test_both_sides_of_the_split_agree_with_the_tags(spark):
    df = hot_feed(spark, 3000, 5).withColumn("_line", F.when(F.col("amount") == 12, "x"))
    tagged = quality.tag_transactions(df, corrupt_column="_line")
    valid, rejected = quality.split_transactions(df, corrupt_column="_line")
    assert spark_bag(valid) == spark_bag(quality.valid_transactions(df, corrupt_column="_line"))
    assert spark_bag(rejected) == spark_bag(tagged.where("reject_reason is not null"))
    assert rejected.where("reject_reason = 'malformed_row'").count() == 1


def test_counting_shuffles_ids_only(spark):
    plan = plan_of(quality.reject_counts(hot_feed(spark, 100, 2)))
    assert "Window" not in plan and "partial_count" in plan
