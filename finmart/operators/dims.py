"""Dimensions: building calendar, branch and account, and looking things up in them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.dates import date_key
from finmart.operators.keys import dense_keys
from finmart.schemas import DIM_ACCOUNT, DIM_BRANCH, FACT_MONTH, RAW_ACCOUNTS, RAW_BRANCHES


def look_up(
    df: DataFrame, dimension: DataFrame, key: str, *columns: str, how: str = "left"
) -> DataFrame:
    """Bring columns of a dimension to the rows that carry its key."""
    return df.join(dimension.select(key, *columns), key, how)


def with_month(dim_date: DataFrame) -> DataFrame:
    """The calendar with the month by which the stored fact is laid out."""
    return dim_date.withColumn(FACT_MONTH, F.expr("cast(date_key div 100 as int)"))


def look_up_day(
    df: DataFrame, dim_date: DataFrame, *columns: str, how: str = "left"
) -> DataFrame:
    """Bring columns of the calendar to the rows that carry its key.

    Rows that still have the month of their folder are joined by it as well. So a filter
    on the calendar reaches the folders of the fact while the query runs (dynamic
    partition pruning): other months are not read.
    """
    if FACT_MONTH not in df.columns:
        return look_up(df, dim_date, "date_key", *columns, how=how)
    days = with_month(dim_date).select("date_key", FACT_MONTH, *columns)
    return df.join(days, ["date_key", FACT_MONTH], how)


def check_unique(feed: DataFrame, key: str) -> None:
    """Raise ValueError if a key occurs twice. Only keys and counts are shuffled."""
    repeated = feed.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").count()
    if repeated:
        raise ValueError(f"{repeated} values of {key} are in their feed twice")


def build_dim_date(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    first, last = (date.fromisoformat(str(day)) for day in (start, end))
    if first > last:
        raise ValueError(f"calendar ends on {last}, before it starts on {first}")
    day = F.col("date")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            F.dayofweek(day).alias("day_of_week"),  # 1 = Sunday .. 7 = Saturday
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        )
    )


def build_dim_branch(raw_branches: DataFrame) -> DataFrame:
    """Branches, numbered by branch_code."""
    branches = raw_branches.select(*RAW_BRANCHES)
    return dense_keys(branches, ["branch_code"], "branch_key").select(*DIM_BRANCH)


def build_dim_account(raw_accounts: DataFrame) -> DataFrame:
    """Accounts, numbered by account_id.

    A status change overwrites the old status: the table is rebuilt from the feed.
    """
    accounts = raw_accounts.select(*RAW_ACCOUNTS).withColumn(
        "opened_date", F.to_date("opened_date")
    )
    return dense_keys(accounts, ["account_id"], "account_key").select(*DIM_ACCOUNT)
