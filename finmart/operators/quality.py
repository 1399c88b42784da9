"""The quality gate of the transaction feed.

Every raw row ends up in exactly one place: valid, or rejected with one reason.
Row rules run first; among the rows that pass them, one row per txn_id survives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.schemas import MONEY
from finmart.sources.scratch import materialize

NULL_FIELD = "null_required_field"
NEGATIVE = "negative_amount"
BAD_AMOUNT = "invalid_amount"
BAD_DATE = "invalid_txn_date"
MALFORMED = "malformed_row"
DUPLICATE = "duplicate_txn_id"
REASONS = (NULL_FIELD, NEGATIVE, BAD_AMOUNT, BAD_DATE, MALFORMED, DUPLICATE)

REQUIRED = ("txn_id", "txn_date", "account_id", "customer_id", "branch_code", "amount")

# Which copy of a txn_id survives: the smallest one in this order. The survivor is
# a matter of content, not of file layout.
TIE_BREAK = (
    "txn_date",
    "account_id",
    "branch_code",
    "amount",
    "fee",
    "channel",
    "txn_type",
    "is_cash",
    "customer_id",
)


def row_reason(strict_dates: bool = True, corrupt_column: str | None = None) -> Column:
    """The first row rule a raw transaction breaks, or NULL.

    The rules look at the value as sent: rounded to money first, -0.004 would pass
    as zero. Money that has no decimal(15,2) value (NaN, out of range) never passes.
    `strict_dates` adds the rule for text that is no date.
    """
    missing = reduce(or_, [F.col(name).isNull() for name in REQUIRED])
    reason = F.when(missing, NULL_FIELD).when(F.col("amount") < 0, NEGATIVE)
    unmoney = [
        F.col(name).isNotNull() & F.col(name).try_cast(MONEY).isNull()
        for name in ("amount", "fee")
    ]
    reason = reason.when(reduce(or_, unmoney), BAD_AMOUNT)
    if strict_dates:
        reason = reason.when(F.col("txn_date").try_cast("date").isNull(), BAD_DATE)
    if corrupt_column:
        reason = reason.when(F.col(corrupt_column).isNotNull(), MALFORMED)
    return reason


# Leads the sort keys of the rankings: eight bytes that settle nearly every comparison.
# The id itself follows, so the groups are exact.
_ID_HASH = "_id_hash"


def _total_order(raw: DataFrame, tie_break: Sequence[str]) -> list[Column]:
    rest = [name for name in raw.columns if name not in tie_break and name != "txn_id"]
    return [F.col(name).asc_nulls_first() for name in (*tie_break, *rest)]


# Bits of the filter that says which ids occur twice; more bits let fewer others through.
_FILTER_BITS = 1 << 24
_BITMAP_BITS = 1 << 15  # bits of the bitmaps that Spark builds


def _may_repeat(passed: DataFrame) -> Column:
    """Whether the id of a row may belong to several of the rows that passed: true for all
    those that do, and for few others.

    Hashes of ids are counted, after map-side aggregation; those found twice set a bit of a
    filter of fixed size, which is written and read as one value.
    """
    spark = passed.sparkSession
    hashes = passed.groupBy(F.xxhash64("txn_id").alias("hash")).agg(F.count("*").alias("n"))
    bit = F.pmod("hash", F.lit(_FILTER_BITS))
    bitmaps = (
        hashes.where("n > 1")
        .select(F.floor(bit / _BITMAP_BITS).alias("part"), (bit % _BITMAP_BITS).alias("at"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    every = spark.range(-(-_FILTER_BITS // _BITMAP_BITS)).withColumnRenamed("id", "part")
    parts = every.join(bitmaps, "part", "left").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("part", "bits"))), lambda entry: entry["bits"]
        ).alias("parts")
    )
    table = materialize(parts, "repeated-ids").scalar()

    own = F.pmod(F.xxhash64("txn_id"), F.lit(_FILTER_BITS))
    at = own % _BITMAP_BITS
    bitmap = F.get(table, F.floor(own / _BITMAP_BITS).cast("int"))
    byte = F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))
    code = F.ascii(F.decode(byte, "ISO-8859-1"))
    return F.coalesce(F.getbit(code, (at % 8).cast("int")) == 1, F.lit(False))


def _parted(
    raw: DataFrame, strict_dates: bool, corrupt_column: str | None
) -> tuple[DataFrame, DataFrame]:
    """(settled, contenders): rows with a reason, or whose id no other row has, and rows
    that may have to compete for their id. Both have `reject_reason`."""
    ruled = raw.withColumn("reject_reason", row_reason(strict_dates, corrupt_column))
    passed = F.col("reject_reason").isNull()
    contends = passed & _may_repeat(ruled.where(passed))
    return ruled.where(~contends), ruled.where(contends)


def _ranked(contenders: DataFrame, raw: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """The contenders; all but the first of each id get their reason.

    Ranking runs in two rounds so that no txn_id has to fit one task. Round one ranks the
    copies of an id within one input partition and settles all but the first of them;
    round two ranks the remaining firsts, at most one per id and input partition. Settled
    rows travel through round two in the lane of their input partition. The partition
    number decides who meets whom, never who wins: the winner is the smallest row, and equal rows are
    equal.
    """
    order = _total_order(raw, tie_break)
    within_part = Window.partitionBy(_ID_HASH, "txn_id", "_part").orderBy(*order)
    round_one = (
        contenders.withColumn("_part", F.spark_partition_id())
        .withColumn(_ID_HASH, F.xxhash64("txn_id"))
        .withColumn("_open", F.row_number().over(within_part) == 1)
    )
    across_parts = Window.partitionBy(_ID_HASH, "txn_id", "_lane").orderBy(*order)
    round_two = round_one.withColumn(
        "_lane", F.when(F.col("_open"), F.lit(-1)).otherwise(F.col("_part"))
    ).withColumn("_first", F.row_number().over(across_parts) == 1)
    loser = ~(F.col("_open") & F.col("_first"))
    return round_two.select(*raw.columns, F.when(loser, DUPLICATE).alias("reject_reason"))


def tag_transactions(
    raw: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    strict_dates: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """All raw rows plus `reject_reason`, NULL on the valid ones.

    Only rows whose id may occur twice are moved and ranked; the others, whatever their
    verdict, stay in the tasks that read them.
    """
    settled, contenders = _parted(raw, strict_dates, corrupt_column)
    return settled.unionByName(_ranked(contenders, raw, tie_break))


def split_transactions(
    raw: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    strict_dates: bool = True,
    corrupt_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected), to write both: the ranked rows are written once for the two sides,
    the others are read from `raw` by either. Valid rows have money, rejected ones are as sent."""
    settled, contenders = _parted(raw, strict_dates, corrupt_column)
    ranked = materialize(_ranked(contenders, raw, tie_break), "contenders")
    valid, rejected = (
        settled.where(side).unionByName(ranked.where(side))
        for side in ("reject_reason is null", "reject_reason is not null")
    )
    dropped = ["reject_reason", *([corrupt_column] if corrupt_column else [])]
    return as_money(valid.drop(*dropped)), rejected


def as_money(df: DataFrame) -> DataFrame:
    """Amounts and fees as exact decimals, the form they keep from staging on."""
    return df.withColumns({name: F.col(name).cast(MONEY) for name in ("amount", "fee")})


def valid_transactions(
    raw: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    strict_dates: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Only the valid rows: the same rows as the untagged ones of `tag_transactions`.

    Without the losers one round is enough. The planner keeps just the first row per
    id on the map side (WindowGroupLimit), so a hot id is folded before the shuffle.
    """
    by_id = Window.partitionBy(_ID_HASH, "txn_id").orderBy(*_total_order(raw, tie_break))
    survivors = (
        raw.where(row_reason(strict_dates, corrupt_column).isNull())
        .withColumn(_ID_HASH, F.xxhash64("txn_id"))
        .withColumn("_rank", F.row_number().over(by_id))
        .where("_rank = 1")
        .drop(_ID_HASH, "_rank")
    )
    if corrupt_column:
        survivors = survivors.drop(corrupt_column)
    return as_money(survivors)


def rejected_transactions(
    raw: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    strict_dates: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """The rejected rows as they were sent, each with its one reason."""
    return tag_transactions(raw, tie_break, strict_dates, corrupt_column).where(
        "reject_reason is not null"
    )


def clean_transactions(raw: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected), each by itself. To store both, use `split_transactions`."""
    return valid_transactions(raw, **options), rejected_transactions(raw, **options)


def _ids_by_reason(raw: DataFrame, strict_dates: bool) -> DataFrame:
    """Row counts per reason, or per txn_id where no row rule is broken.

    Counting needs no ranking: of n copies of an id, one is valid and n - 1 are
    duplicates. Only ids and counts are shuffled, after map-side aggregation. Corrupt
    lines show only where all columns are read: count those in the tagged rows.
    """
    reason = row_reason(strict_dates).alias("reason")
    ruled = raw.select(reason, "txn_id")
    return ruled.groupBy(
        "reason", F.when(F.col("reason").isNull(), F.col("txn_id")).alias("id")
    ).agg(F.count("*").alias("n"))


def reject_counts(raw: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Rejected rows per reason; reasons that do not occur are left out."""
    return (
        _ids_by_reason(raw, strict_dates)
        .withColumn(
            "n", F.when(F.col("reason").isNull(), F.col("n") - 1).otherwise(F.col("n"))
        )
        .groupBy(F.coalesce("reason", F.lit(DUPLICATE)).alias("reject_reason"))
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
    )


def gate_totals(raw: DataFrame, strict_dates: bool = True) -> DataFrame:
    """One row: total, valid and rejected."""
    sums = _ids_by_reason(raw, strict_dates).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
    )
    return sums.select("total", "valid", (F.col("total") - F.col("valid")).alias("rejected"))
