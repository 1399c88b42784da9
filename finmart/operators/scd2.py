"""Type-2 history of the customer dimension.

A version is valid on [effective_from, effective_to); the open one has no end.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.operators.keys import dense_keys
from finmart.schemas import DIM_CUSTOMER, TRACKED
from finmart.sources.scratch import materialize

_SNAPSHOT = ("customer_id", *TRACKED, "snapshot_date")


def _differs(left: str, right: str) -> Column:
    """Whether a tracked attribute differs; NULL and '' count as the same."""
    return reduce(
        or_,
        [
            F.coalesce(F.col(f"{left}{name}"), F.lit(""))
            != F.coalesce(F.col(f"{right}{name}"), F.lit(""))
            for name in TRACKED
        ],
    )


def check_snapshot(incoming: DataFrame, once_per: Sequence[str] = ("customer_id",)) -> None:
    """Raise ValueError unless every row has an id and a date and none repeats."""
    found = (
        incoming.groupBy(*once_per)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("customer_id").isNull()).alias("nameless"),
            F.count_if(F.col("snapshot_date").isNull()).alias("undated"),
        )
        .agg(
            F.sum("nameless").alias("nameless"),
            F.sum("undated").alias("undated"),
            F.count_if(F.col("n") > 1).alias("repeated"),
        )
        .first()
    )
    faults = {name: count for name, count in found.asDict().items() if count}
    if faults:
        raise ValueError(f"customer snapshot is not one dated row per customer: {faults}")


def _checked(dim: DataFrame) -> DataFrame:
    """The history; fails while it is read if versions of a customer overlap, such as two
    open ones. It is dealt by customer, as the merge needs it anyway."""
    by_customer = Window.partitionBy("customer_id").orderBy("effective_from", "customer_key")
    following = F.lead("effective_from").over(by_customer)
    ends_late = F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_next"))
    overlap = F.raise_error(
        F.concat(F.lit("a version overlaps the next one of customer "), F.col("customer_id"))
    )
    return (
        dim.select(*DIM_CUSTOMER, following.alias("_next"))
        .withColumn(
            "customer_key",
            F.when(F.col("_next").isNotNull() & ends_late, overlap).otherwise(F.col("customer_key")),
        )
        .drop("_next")
    )


def _open_versions(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def _row(**columns: Column) -> Column:
    return F.struct(*[columns[name].cast(kind).alias(name) for name, kind in DIM_CUSTOMER.items()])


def _actions(current_dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """The rows of the merged history, those of new versions without a key, by one join.

    Each version meets the customer's row of the snapshot if it is open, and gives one row,
    or two if it ends there; a customer without an open version gives one.
    """
    now = incoming.select(*[F.col(name).alias(f"_now_{name}") for name in _SNAPSHOT])
    history = _checked(current_dim)
    meet = (F.col("customer_id") == F.col("_now_customer_id")) & F.col("is_current")
    joined = history.join(now, meet, "full_outer")

    known = F.col("customer_key").isNotNull()
    day = F.col("_now_snapshot_date")
    stale = F.raise_error(
        F.concat(
            F.lit("snapshot is not newer than the open version of customer "),
            F.col("customer_id"),
        )
    )
    was = {name: F.col(name) for name in DIM_CUSTOMER}
    ended = _row(
        **{
            **was,
            "effective_to": F.when(day <= F.col("effective_from"), stale).otherwise(day),
            "is_current": F.lit(False),
        }
    )
    opened = _row(
        customer_key=F.lit(None),
        customer_id=F.col("_now_customer_id"),
        **{name: F.col(f"_now_{name}") for name in TRACKED},
        effective_from=day,
        effective_to=F.lit(None),
        is_current=F.lit(True),
    )
    rows = (
        F.when(~known, F.array(opened))
        .when(day.isNotNull() & _differs("", "_now_"), F.array(ended, opened))
        .otherwise(F.array(_row(**was)))
    )
    return joined.select(F.explode(rows).alias("version")).select("version.*")


def scd2_merge(current_dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Apply one snapshot to the dimension.

    new customer      -> a new open version
    changed customer  -> the open version ends on the snapshot date, a new one opens
    otherwise         -> the version stays as it is, in the snapshot or not
    Closed versions are carried over. New keys continue after the largest one.
    """
    incoming = incoming.select(*_SNAPSHOT)
    check_snapshot(incoming)
    merged = materialize(_actions(current_dim.select(*DIM_CUSTOMER), incoming), "merged")
    arrived = merged.where("customer_key is null").drop("customer_key")
    top_key = current_dim.agg(F.coalesce(F.max("customer_key"), F.lit(0))).scalar()
    numbered = dense_keys(arrived, ["customer_id", "effective_from"], "customer_key", start=top_key)
    return merged.where("customer_key is not null").unionByName(numbered.select(*DIM_CUSTOMER))


def scd2_change_classes(current_dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """How many customers a merge would find absent, changed, new or unchanged."""
    opened = _open_versions(current_dim).select(
        "customer_id",
        *[F.col(name).alias(f"_was_{name}") for name in TRACKED],
        F.lit(True).alias("_known"),
    )
    seen = incoming.select("customer_id", *TRACKED, F.lit(True).alias("_seen"))
    found = (
        F.when(F.col("_seen").isNull(), "absent")
        .when(F.col("_known").isNull(), "new")
        .when(_differs("", "_was_"), "changed")
        .otherwise("unchanged")
    )
    return (
        opened.join(seen, "customer_id", "full_outer")
        .groupBy(found.alias("class"))
        .agg(F.count("*").alias("n"))
    )


def scd2_replay(snapshots: Sequence[DataFrame]) -> DataFrame:
    """The dimension after merging the snapshots, oldest first, into an empty one.

    The snapshots are replayed in one pass instead of one merge each. A customer's
    rows in date order tell it all: a row that differs from the one before starts a
    version, which ends where the next one starts. A merge numbers its new versions
    by customer after those of earlier snapshots, which is the order (effective_from,
    customer_id) of all versions. Every snapshot has one snapshot_date of its own.
    """
    history = reduce(
        DataFrame.unionByName, [snapshot.select(*_SNAPSHOT) for snapshot in snapshots]
    )
    check_snapshot(history, once_per=("customer_id", "snapshot_date"))

    by_customer = Window.partitionBy("customer_id").orderBy("snapshot_date")
    before = {f"_was_{name}": F.lag(name).over(by_customer) for name in TRACKED}
    starts = history.withColumns(
        {**before, "_seen": F.row_number().over(by_customer)}
    ).where((F.col("_seen") == 1) | _differs("", "_was_"))
    versions = starts.select(
        "customer_id",
        *TRACKED,
        F.col("snapshot_date").alias("effective_from"),
        F.lead("snapshot_date").over(by_customer).alias("effective_to"),
    ).withColumn("is_current", F.col("effective_to").isNull())
    return dense_keys(
        versions, ["effective_from", "customer_id"], "customer_key"
    ).select(*DIM_CUSTOMER)
