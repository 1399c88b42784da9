"""Star-join analytics.

Each query sums the fact by integer keys first and joins the sums to the texts. A
hot key is folded on the map side, and a dimension too large to broadcast meets
one row per key instead of the whole fact. Accounts are the exception: sums by account are
nearly as many as rows, so rows take their product type first and fold into few sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.operators.dims import look_up, look_up_day
from finmart.schemas import FACT_MONTH


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum("amount").alias("_total"))


def _daily(fact: DataFrame, *keys: str) -> DataFrame:
    """Sums by day; the month goes with the day and makes no more groups."""
    month = [FACT_MONTH] if FACT_MONTH in fact.columns else []
    return _sums(fact, "date_key", *month, *keys)


def _count() -> Column:
    return F.sum("_n")


def _amount() -> Column:
    return F.sum("_total").cast("decimal(25,2)")


def cash_by_branch_month(fact: DataFrame, dim_date: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Monthly cash and non-cash volume per branch."""
    sums = _daily(fact, "branch_key", "is_cash")
    told = look_up_day(sums, dim_date, "year", "month", how="inner")
    told = look_up(told, dim_branch, "branch_key", "branch_name", how="inner")
    return (
        told.groupBy("year", "month", "branch_name", "is_cash")
        .agg(_count().alias("txn_count"), _amount().alias("total_amount"))
        .orderBy("year", "month", "branch_name", "is_cash")
    )


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    """The customers with the largest amounts, booked on their current version.

    What was booked on a closed version does not count: the fact points at it, and
    only current versions are joined.
    """
    who = ("customer_id", "name", "segment", "province")
    current = dim_customer.where("is_current")
    return (
        look_up(_sums(fact, "customer_key"), current, "customer_key", *who, how="inner")
        .groupBy(*who)
        .agg(_count().alias("txn_count"), _amount().alias("total_amount"))
        .orderBy(F.desc("total_amount"), "customer_id")
        .limit(n)
    )


def product_mix_by_region(
    fact: DataFrame,
    dim_branch: DataFrame,
    dim_account: DataFrame,
    account: Sequence[str] = ("account_key",),
) -> DataFrame:
    """Count and mean amount per region and product type; `account` are the columns by
    which fact and accounts meet."""
    products = dim_account.select(*account, "product_type")
    sold = fact.select("branch_key", *account, "amount").join(products, list(account), "inner")
    sums = _sums(sold, "branch_key", "product_type")
    return (
        look_up(sums, dim_branch, "branch_key", "region", how="inner")
        .groupBy("region", "product_type")
        .agg(_count().alias("txn_count"), _amount().alias("_amount"))
        .select(
            "region",
            "product_type",
            "txn_count",
            (F.col("_amount") / F.col("txn_count")).cast("decimal(19,6)").alias("avg_amount"),
        )
        .orderBy("region", "product_type")
    )


def weekend_cash(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Cash count and amount on weekdays and weekends."""
    sums = _daily(fact.where("is_cash"))
    return (
        look_up_day(sums, dim_date, "is_weekend", how="inner")
        .groupBy("is_weekend")
        .agg(_count().alias("cash_txn_count"), _amount().alias("cash_total_amount"))
        .orderBy("is_weekend")
    )
