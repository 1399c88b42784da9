"""The fact laid out by account: joins and sums by account without moving it again.

Rows lie in buckets of (account_key, part). An account has one part unless it has more
than a share of the rows of a bucket; such a hot account, or the rows without an account,
has as many parts as keep each to that share, so no bucket has to take it whole. The
account dimension gets a row for each part. Both ends of a join then agree on the bucket,
and only the dimension is shuffled.

The months stay folders, so a period still reads its own only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.schemas import FACT_MONTH, FACT_TRANSACTIONS, ddl
from finmart.sources.scratch import materialize

ACCOUNT_PART = ("account_key", "part")

# An account of more than 1 / _SHARES of the mean bucket has several parts, so there are
# at most _SHARES of these accounts for each bucket.
_SHARES = 4

_FILES = {**FACT_TRANSACTIONS, "part": "bigint", FACT_MONTH: "int"}


def hot_accounts(fact: DataFrame, buckets: int) -> DataFrame:
    """(account_key, parts): the accounts that need more than one part; the key may be null.

    At most 4 rows for each bucket.
    """
    counts = materialize(fact.groupBy("account_key").agg(F.count("*").alias("n")), "account-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    share = F.greatest(F.ceil(total / (_SHARES * buckets)), F.lit(1))
    return counts.select("account_key", F.ceil(F.col("n") / share).alias("parts")).where("parts > 1")


def write_by_account(
    fact: DataFrame, dim_account: DataFrame, path: str, table: str, buckets: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write the fact by account below `path` and make it known as `table`; returns it, and
    the accounts with a row for each of their parts.

    Without `buckets` there are as many as shuffle tasks. With fewer than these Spark would
    rather shuffle than use the buckets.
    """
    spark = fact.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = materialize(hot_accounts(fact, buckets), "hot-accounts")
    known = F.broadcast(hot.withColumnRenamed("account_key", "_account"))
    rows = fact.join(known, fact["account_key"].eqNullSafe(F.col("_account")), "left")
    (
        rows.withColumn("part", F.pmod(F.xxhash64("txn_id"), F.coalesce("parts", F.lit(1))))
        .withColumn(FACT_MONTH, F.expr("cast(date_key div 100 as int)"))
        .select(*_FILES)
        # The hash that buckets go by as well: a task writes whole buckets.
        .repartition(buckets, *ACCOUNT_PART)
        .sortWithinPartitions(FACT_MONTH, *ACCOUNT_PART)
        .write.partitionBy(FACT_MONTH)
        .bucketBy(buckets, *ACCOUNT_PART)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table), with_parts(dim_account, hot)


def read_by_account(spark: SparkSession, path: str, table: str, buckets: int) -> DataFrame:
    """Make a fact known as `table` that another session has written."""
    where = path.replace("'", "\\'")
    spark.sql(
        f"create table {table} ({ddl(_FILES)}) using parquet partitioned by ({FACT_MONTH}) "
        f"clustered by ({', '.join(ACCOUNT_PART)}) into {buckets} buckets location '{where}'"
    )
    spark.sql(f"msck repair table {table}")
    return spark.table(table)


def with_parts(dim_account: DataFrame, hot: DataFrame) -> DataFrame:
    """The accounts with a row for each of their parts."""
    last = F.coalesce("parts", F.lit(1)) - 1
    return (
        dim_account.join(F.broadcast(hot), "account_key", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop("parts")
    )
