"""The transaction fact: surrogate keys for natural ones, one row per transaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from finmart.functions.dates import date_key
from finmart.operators.dims import look_up
from finmart.schemas import FACT_TRANSACTIONS
from finmart.sources.scratch import materialize


# Versions in a block of a customer's history. A lookup goes through the first days of
# the blocks and then through one block.
_BLOCK = 64


def histories(dim_customer: DataFrame) -> DataFrame:
    """(customer_id, blocks): one row per customer, written, with its versions by day.

    The join on the customer then gives one row per transaction however many versions
    there are. Fails if versions overlap, as they would book a transaction twice.
    """
    versions = F.array_sort(
        F.collect_list(F.struct("effective_from", "customer_key", "effective_to"))
    )
    grouped = dim_customer.where("customer_id is not null").groupBy("customer_id").agg(versions.alias("versions"))

    def ends_late(k: Column) -> Column:
        end = F.get("versions", k - 1)["effective_to"]
        return end.isNull() | (end > F.get("versions", k)["effective_from"])

    n = F.size("versions")
    overlap = F.when(n > 1, F.exists(F.sequence(F.lit(1), n - 1), ends_late)).otherwise(F.lit(False))
    late = F.raise_error(
        F.concat(F.lit("versions overlap in the history of customer "), F.col("customer_id"))
    )
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
        lambda k: F.struct(
            F.get("versions", k * _BLOCK)["effective_from"].alias("start"),
            F.slice("versions", k * _BLOCK + 1, F.lit(_BLOCK)).alias("versions"),
        ),
    )
    return materialize(
        grouped.select("customer_id", F.when(overlap, late).otherwise(blocks).alias("blocks")),
        "histories",
    )


def _in_effect(day: Column) -> Column:
    """The key of the version in effect on a day, from the blocks of a history."""
    block = F.try_element_at(F.filter("blocks", lambda b: b["start"] <= day), F.lit(-1))
    version = F.try_element_at(
        F.filter(block["versions"], lambda v: v["effective_from"] <= day), F.lit(-1)
    )
    ended = day >= version["effective_to"]
    return F.when(ended, F.lit(None)).otherwise(version["customer_key"])


def build_fact_transactions(
    valid: DataFrame, dim_customer: DataFrame, dim_account: DataFrame, dim_branch: DataFrame
) -> DataFrame:
    """Resolve the keys of clean transactions.

    The customer key is that of the version in effect on the day of the transaction;
    on the day of a change that is already the new version. A key that cannot be
    resolved is NULL and the row stays. `channel` needs no dimension of its own.

    Whether a dimension is broadcast is left to its measured size; beyond the
    threshold the join sorts, and adaptive execution splits a hot customer.
    """
    day = F.col("_day")
    # Text that is no date, which a lenient gate lets pass, has no day and no key.
    dated = valid.withColumn("_day", F.col("txn_date").try_cast("date"))
    keyed = look_up(dated, histories(dim_customer), "customer_id", "blocks")
    keyed = keyed.withColumn("customer_key", _in_effect(day)).drop("blocks")
    keyed = look_up(keyed, dim_account, "account_id", "account_key")
    keyed = look_up(keyed, dim_branch, "branch_code", "branch_key")
    return keyed.withColumn("date_key", date_key(day)).select(*FACT_TRANSACTIONS)


def check_fact(months: Sequence[Row], n_valid: int, dimensions: Mapping[str, DataFrame]) -> None:
    """Raise ValueError unless the fact has one row per valid one and only known keys.

    `months` are the counts by month, see `fact_counts`; `dimensions` has a frame for each
    key column.
    """
    n = sum(row.n for row in months)
    if n != n_valid:
        raise ValueError(f"the fact has {n} rows for {n_valid} valid ones")
    for key, dimension in dimensions.items():
        found = max((row[key] for row in months if row[key] is not None), default=None)
        top = dimension.agg(F.max(key)).first()[0]
        if found is not None and (top is None or found > top):
            raise ValueError(f"the fact has {key} {found}, the dimension ends at {top}")


def fact_counts(fact: DataFrame, month: str) -> list[Row]:
    """Rows and largest keys of each month: a row per month."""
    keys = ("customer_key", "account_key", "branch_key")
    return fact.groupBy(month).agg(F.count("*").alias("n"), *[F.max(k).alias(k) for k in keys]).collect()


def unresolved_keys(fact: DataFrame) -> DataFrame:
    """One row: how many fact rows lack which key."""
    names = ("date_key", "customer_key", "account_key", "branch_key")
    return fact.agg(
        F.count("*").alias("fact_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in names],
    )
