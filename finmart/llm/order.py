"""Rows in one global order: range-sorted, written, and summed along it.

No sort, window or sum here has more than one range partition of rows in a task. What is
summed over all partitions is one row for each partition (and key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.sources.scratch import materialize

# monotonically_increasing_id() = task number << 33 | row number in the task
_TASK_SHIFT = 33
_ROW_MASK = 2**33 - 1


def in_order(df: DataFrame, ordering: Sequence[str], label: str) -> DataFrame:
    """`df` written in the order of some columns, with its `task` and place (`slot`) there.

    The columns should tell all rows apart, so that none has to share a partition with
    more rows than others."""
    placed = (
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("slot", F.monotonically_increasing_id())
    )
    return materialize(placed, label).withColumns(
        {
            "task": F.shiftright("slot", _TASK_SHIFT),
            "slot": F.col("slot").bitwiseAND(F.lit(_ROW_MASK)),
        }
    )


def _before(placed: DataFrame, value: Column, name: str, keys: Sequence[str]) -> DataFrame:
    """(task, keys, name): the sum of `value` in the tasks before."""
    totals = placed.groupBy("task", *keys).agg(F.sum(value).alias(name))
    earlier = Window.partitionBy(*keys).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(name).over(earlier), F.lit(0)))


def numbered(placed: DataFrame, name: str) -> DataFrame:
    """Number the rows 1, 2, ... in their order."""
    start = _before(placed, F.lit(1), "_start", [])
    # One row for each range partition.
    return placed.join(F.broadcast(start), "task").select(
        *[c for c in placed.columns if c not in ("task", "slot")],
        (F.col("_start") + F.col("slot") + 1).alias(name),
    )


def summed_before(placed: DataFrame, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the sum of `value` over the rows before, of the same keys."""
    keys = list(keys)
    start = _before(placed, F.col(value), "_start", keys)
    within = (
        Window.partitionBy("task", *keys)
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = placed.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inside.join(start, ["task", *keys]).select(
        *[c for c in placed.columns if c not in ("task", "slot")],
        (F.col("_start") + F.col("_inside")).alias(name),
    )
