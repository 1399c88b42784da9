"""finmart: dimensional warehousing and regulatory reporting on Spark DataFrames."""

from finmart.operators.dims import build_dim_account, build_dim_branch, build_dim_date
from finmart.operators.fact import build_fact_transactions, unresolved_keys
from finmart.operators.keys import dense_keys
from finmart.operators.quality import clean_transactions, gate_totals, reject_counts
from finmart.operators.scd2 import scd2_change_classes, scd2_merge, scd2_replay
from finmart.plans.analytics import (
    cash_by_branch_month,
    product_mix_by_region,
    top_customers,
    weekend_cash,
)
from finmart.plans.reports import ctr_report, monthly_summary_report, report_months
from finmart.sources.jdbc import write_jdbc
from finmart.sources.lake import Lake
from finmart.sources.session import get_spark_session

__all__ = [
    "Lake",
    "build_dim_account",
    "build_dim_branch",
    "build_dim_date",
    "build_fact_transactions",
    "cash_by_branch_month",
    "clean_transactions",
    "ctr_report",
    "dense_keys",
    "gate_totals",
    "get_spark_session",
    "monthly_summary_report",
    "product_mix_by_region",
    "reject_counts",
    "report_months",
    "scd2_change_classes",
    "scd2_merge",
    "scd2_replay",
    "top_customers",
    "unresolved_keys",
    "weekend_cash",
    "write_jdbc",
]
