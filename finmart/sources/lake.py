"""The zones of the lake and the files in them."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from finmart.operators.keys import dense_keys
from finmart.schemas import FACT_MONTH, FACT_TRANSACTIONS, MONEY, RAW_TRANSACTIONS, ddl
from finmart.sources.scratch import materialize


@dataclass(frozen=True)
class Lake:
    """Zone paths below one base path on any file system Spark can reach."""

    base: str

    def raw(self, feed: str) -> str:
        return f"{self.base}/raw/{feed}"

    def staging(self, feed: str) -> str:
        return f"{self.base}/staging/{feed}"

    @property
    def rejects(self) -> str:
        return self.staging("_rejects")

    def warehouse(self, table: str) -> str:
        return f"{self.base}/warehouse/{table}"

    def report(self, name: str) -> str:
        return f"{self.base}/reports/{name}"


def read_csv(
    spark: SparkSession, path: str, contract: dict[str, str], corrupt_column: str | None = None
) -> DataFrame:
    """A CSV feed with header under its declared schema.

    Empty cells and cells of the wrong type are NULL. With `corrupt_column` the text
    of lines that do not fit the schema is kept in that column. Spark checks the cells
    a query reads; that column is made from all of them, so whoever reads it has them checked.
    """
    reader = spark.read.option("header", True)
    if not corrupt_column:
        return reader.schema(ddl(contract)).csv(path)
    reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    rows = reader.schema(ddl({**contract, corrupt_column: "string"})).csv(path)
    # Holds for any hash, which the optimizer does not know.
    all_read = F.xxhash64(*contract) >= F.lit(-(2**63))
    return rows.withColumn(corrupt_column, F.when(all_read, F.col(corrupt_column)))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, contract: dict[str, str]) -> DataFrame:
    return spark.read.schema(ddl(contract)).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# Gate output: valid rows with exact money, and rejected ones as they were sent.

_GATE = {**RAW_TRANSACTIONS, "reject_reason": "string"}
_VALID = {
    name: MONEY if name in ("amount", "fee") else kind for name, kind in RAW_TRANSACTIONS.items()
}


def write_gate(
    valid: DataFrame, rejected: DataFrame, valid_path: str, rejects_path: str
) -> None:
    """Write each side straight to its folder, with the rows where they were read."""
    write_parquet(valid.select(*RAW_TRANSACTIONS), valid_path)
    write_parquet(rejected.select(*_GATE), rejects_path)


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, _VALID)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, _GATE)


# The fact lies in a folder per month, sorted by day in each file: a date range
# skips folders by name and row groups by their statistics.

_FACT_FILES = {**FACT_TRANSACTIONS, FACT_MONTH: "int"}


def write_fact(fact: DataFrame, path: str) -> None:
    """Rows of a day travel together; adaptive execution splits the days that are
    too large for one task and packs the small ones into files of a good size."""
    (
        fact.withColumn("txn_month", F.expr("cast(date_key div 100 as int)"))
        .hint("rebalance", "date_key")
        .sortWithinPartitions("txn_month", "date_key")
        .write.mode("overwrite")
        .partitionBy("txn_month")
        .parquet(path)
    )


def read_fact_files(spark: SparkSession, path: str) -> DataFrame:
    """The fact with the month of its folder."""
    return read_parquet(spark, path, _FACT_FILES)


def read_fact(
    spark: SparkSession,
    path: str,
    first: date | None = None,
    last: date | None = None,
    months: Collection[int | None] | None = None,
    with_month: bool = False,
) -> DataFrame:
    """The fact, or the part of it between two days, both included, or of some months;
    with the month of each row's folder if asked for."""
    rows = read_fact_files(spark, path)
    if months is not None:
        dated = F.col("txn_month").isin([month for month in months if month is not None])
        rows = rows.where(dated | F.col("txn_month").isNull() if None in months else dated)
    for day, beyond in ((first, "__ge__"), (last, "__le__")):
        if day:
            key = day.year * 10000 + day.month * 100 + day.day
            month_inside = getattr(F.col("txn_month"), beyond)(key // 100)
            rows = rows.where(month_inside & getattr(F.col("date_key"), beyond)(key))
    return rows.select(*(_FACT_FILES if with_month else FACT_TRANSACTIONS))


# Reports.

FILE_ROWS = 1_000_000  # rows of a report file


def write_partitioned_csv(df: DataFrame, path: str, by: str, file_rows: int = 0) -> None:
    """CSV with one folder per value of `by`; any size. `file_rows` limits the rows of a file."""
    _csv_files(df, file_rows).partitionBy(by).csv(path)


def _csv_files(df: DataFrame, file_rows: int) -> DataFrameWriter:
    writer = df.write.mode("overwrite").option("header", True)
    return writer.option("maxRecordsPerFile", file_rows)


def read_partitioned_csv(
    spark: SparkSession, path: str, contract: dict[str, str], by: str
) -> DataFrame:
    """Read such a folder tree back, `by` as text; rows without a value have NULL."""
    files = {name: kind for name, kind in contract.items() if name != by}
    rows = read_csv(spark, path, {**files, by: "string"})
    return rows.select(*contract)


def month_files(
    df: DataFrame, by: str, order_by: list[str], file_rows: int = FILE_ROWS
) -> DataFrame:
    """Lay rows out so that `write_partitioned_csv`, with the same limit, makes exactly
    ceil(rows / file_rows) files of each month, which follow each other in order.

    Rows are numbered in order, so each knows its file: its place in the month over the
    limit. Rows of a file are never parted; a task that has several files of a month has
    them whole and in order, and the writer begins a new one after as many rows.
    """
    placed = materialize(dense_keys(df, [by, *order_by], "_place"), "placed")
    # One row per month.
    months = placed.groupBy(F.col(by).alias("_month")).agg(F.min("_place").alias("_first"))
    number = F.floor((F.col("_place") - F.col("_first")) / file_rows)
    return (
        placed.join(F.broadcast(months), placed[by].eqNullSafe(F.col("_month")))
        .withColumn("_file", number)
        .repartitionByRange(by, "_file")
        .sortWithinPartitions(by, "_place")
        .select(*df.columns)
    )


def write_report(
    df: DataFrame,
    path: str,
    by: str,
    order_by: list[str],
    months: Sequence[str] | None = None,
    file_rows: int = FILE_ROWS,
) -> int:
    """Write a report by month, all of it or only some months; returns the row count.

    The folders of the months given are replaced one by one, also by nothing, which any
    committer can do; other months stay as they are.
    """
    rows = materialize(df, "report")
    if months is None:
        write_partitioned_csv(month_files(rows, by, order_by, file_rows), path, by, file_rows)
        return rows.count()
    for month in months:
        part = month_files(rows.where(F.col(by) == month), by, order_by, file_rows)
        _csv_files(part.drop(by), file_rows).csv(f"{path}/{by}={month}")
    return rows.where(F.col(by).isin(list(months))).count()


def write_one_csv(df: DataFrame, path: str) -> None:
    """One file, for a result as small as a report: a row per group of a few columns."""
    write_csv(df.coalesce(1), path)
