"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.sources.scratch import materialize

_INT_MAX = 2**31 - 1
# monotonically_increasing_id() = task number << 33 | row number in the task
_TASK_SHIFT = 33
_ROW_MASK = 2**33 - 1


def dense_keys(
    df: DataFrame, order_by: Sequence[str], key: str, start: int | Column = 0
) -> DataFrame:
    """Add `key` = start + 1, start + 2, ... in the order of `order_by`; `start` may be a
    value that the query finds out, such as the largest key of a table.

    The remaining columns follow in the order, so only equal rows can tie. The rows
    are range partitioned, sorted within their partition and written down with their
    position; a key is then the position plus the number of rows in earlier
    partitions. What reaches the driver is one count per partition.
    """
    ordering = [*order_by, *[name for name in df.columns if name not in order_by]]
    placed = materialize(
        # Equal rows may be many: the input partition number spreads them as well.
        df.withColumn("_part", F.spark_partition_id())
        .repartitionByRange(*ordering, "_part")
        .sortWithinPartitions(*ordering)
        .drop("_part")
        .withColumn("_slot", F.monotonically_increasing_id()),
        f"keys-{key}",
    )
    task = F.shiftright("_slot", _TASK_SHIFT)
    position = F.col("_slot").bitwiseAND(F.lit(_ROW_MASK))

    sizes = dict(placed.groupBy(task.alias("task")).agg(F.count("*")).collect())
    total = sum(sizes.values())
    if (total if isinstance(start, Column) else start + total) > _INT_MAX:
        raise OverflowError(f"{key}: {start} + {total} keys do not fit an int")

    if len(sizes) > 1:
        tasks = sorted(sizes)
        before = accumulate([sizes[t] for t in tasks], initial=0)
        offsets = df.sparkSession.createDataFrame(
            list(zip(tasks, before)), "_task bigint, _before bigint"
        )
        # One row per range partition, so the size of this broadcast is known.
        placed = placed.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    else:
        placed = placed.withColumn("_before", F.lit(0))
    first = F.lit(start).cast("long") + 1
    number = F.col("_before") + position + first
    beyond = F.raise_error(F.lit(f"{key}: the keys do not fit an int"))
    fitting = F.when(number > _INT_MAX, beyond).otherwise(number)
    return placed.select(fitting.cast("int").alias(key), *df.columns)
