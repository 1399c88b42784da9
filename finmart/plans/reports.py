"""The two regulatory reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.functions.dates import report_month
from finmart.operators.dims import look_up
from finmart.schemas import CTR_REPORT

CTR_THRESHOLD = 2_000_000


def ctr_hits(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_branch: DataFrame,
    dim_date: DataFrame,
    threshold: int = CTR_THRESHOLD,
) -> DataFrame:
    """Cash transactions of at least `threshold`, one row each, in no order.

    The filter sits on bare fact columns, so it reaches the scan, and only the hits
    meet the dimensions. Customer attributes are those of the fact's version, which
    was in effect on the day, not today's.
    """
    hits = fact.where(F.col("is_cash") & (F.col("amount") >= F.lit(threshold)))
    told = look_up(hits, dim_date, "date_key", "date")
    told = look_up(told, dim_customer, "customer_key", "customer_id", "name", "segment")
    told = look_up(told, dim_branch, "branch_key", "branch_code", "branch_name", "province")
    return told.withColumn("report_month", report_month(F.col("date"))).select(*CTR_REPORT)


def ctr_report(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_branch: DataFrame,
    dim_date: DataFrame,
    threshold: int = CTR_THRESHOLD,
) -> DataFrame:
    """The hits by date and id."""
    return ctr_hits(fact, dim_customer, dim_branch, dim_date, threshold).orderBy("date", "txn_id")


def report_months(report: DataFrame) -> DataFrame:
    """The months that occur in a report."""
    return report.select("report_month").distinct().orderBy("report_month")


def monthly_summary_report(
    fact: DataFrame,
    dim_branch: DataFrame,
    dim_account: DataFrame,
    dim_date: DataFrame,
    account: Sequence[str] = ("account_key",),
) -> DataFrame:
    """Count and amount per month, branch, product type and transaction type.

    Fact rows take the product type of their account and are then summed per day, branch,
    product and type: few groups, folded where the rows are. Sums by account first would be
    nearly as many as rows. `account` are the columns by which fact and accounts meet: a fact
    that lies by them is not moved; otherwise adaptive execution splits a hot account. The
    texts join the sums, which are then summed again. Counts and decimal sums do not mind the
    regrouping.
    """
    # One product type per key even if an account table has a key twice.
    products = dim_account.groupBy(*account).agg(F.min("product_type").alias("product_type"))
    daily = (
        fact.select("date_key", "branch_key", *account, "txn_type", "amount")
        .join(products, list(account), "left")
        .groupBy("date_key", "branch_key", "product_type", "txn_type")
        .agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(25,2)").alias("total"))
    )
    told = look_up(daily, dim_date, "date_key", "date")
    told = look_up(told, dim_branch, "branch_key", "branch_name", "province")
    return (
        told.withColumn("report_month", report_month(F.col("date")))
        .groupBy("report_month", "branch_name", "province", "product_type", "txn_type")
        .agg(
            F.sum("n").alias("txn_count"),
            F.sum("total").cast("decimal(25,2)").alias("total_amount"),
        )
        .orderBy("report_month", "branch_name", "province", "product_type", "txn_type")
    )
