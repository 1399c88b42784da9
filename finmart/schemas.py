"""Column contracts of every feed and table, as ordered name -> Spark SQL type maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"

# Raw feeds. Dates are text until the gate has looked at them, and the two money
# columns keep the feed's floating point so that the rules see the value as sent.
RAW_BRANCHES = {
    "branch_code": "string",
    "branch_name": "string",
    "province": "string",
    "region": "string",
}
RAW_ACCOUNTS = {
    "account_id": "string",
    "customer_id": "string",
    "product_type": "string",
    "currency": "string",
    "opened_date": "string",
    "status": "string",
}
RAW_CUSTOMERS = {
    "customer_id": "string",
    "name": "string",
    "segment": "string",
    "province": "string",
    "kyc_level": "string",
    "snapshot_date": "string",
}
RAW_TRANSACTIONS = {
    "txn_id": "string",
    "txn_date": "string",
    "account_id": "string",
    "customer_id": "string",
    "branch_code": "string",
    "channel": "string",
    "txn_type": "string",
    "is_cash": "boolean",
    "amount": "double",
    "fee": "double",
}

# Star schema.
DIM_DATE = {
    "date_key": "int",
    "date": "date",
    "year": "int",
    "quarter": "int",
    "month": "int",
    "month_name": "string",
    "day": "int",
    "day_of_week": "int",
    "is_weekend": "boolean",
}
DIM_BRANCH = {"branch_key": "int", **RAW_BRANCHES}
DIM_ACCOUNT = {"account_key": "int", **RAW_ACCOUNTS, "opened_date": "date"}
DIM_CUSTOMER = {
    "customer_key": "int",
    "customer_id": "string",
    "name": "string",
    "segment": "string",
    "province": "string",
    "kyc_level": "string",
    "effective_from": "date",
    "effective_to": "date",
    "is_current": "boolean",
}
FACT_TRANSACTIONS = {
    "txn_id": "string",
    "date_key": "int",
    "customer_key": "int",
    "account_key": "int",
    "branch_key": "int",
    "channel": "string",
    "txn_type": "string",
    "is_cash": "boolean",
    "amount": MONEY,
    "fee": MONEY,
}

# The month of the folder a fact row lies in, as 202604: part of the stored fact, not of
# its contract. Joins with the calendar that carry it read only the months they need.
FACT_MONTH = "txn_month"

# One row of the threshold report.
CTR_REPORT = {
    "txn_id": "string",
    "date": "date",
    "report_month": "string",
    "customer_id": "string",
    "name": "string",
    "segment": "string",
    "branch_code": "string",
    "branch_name": "string",
    "province": "string",
    "channel": "string",
    "txn_type": "string",
    "is_cash": "boolean",
    "amount": MONEY,
    "fee": MONEY,
}

# One row of the monthly summary.
MONTHLY_SUMMARY = {
    "report_month": "string",
    "branch_name": "string",
    "province": "string",
    "product_type": "string",
    "txn_type": "string",
    "txn_count": "bigint",
    "total_amount": "decimal(25,2)",
}

# A change in any of these opens a new customer version.
TRACKED = ("name", "segment", "province", "kyc_level")


def ddl(contract: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in contract.items())


def empty(spark: SparkSession, contract: dict[str, str]) -> DataFrame:
    """A typed frame without rows that the optimizer can see to be empty."""
    columns = [F.lit(None).cast(kind).alias(name) for name, kind in contract.items()]
    return spark.range(1).where(F.lit(False)).select(*columns)
