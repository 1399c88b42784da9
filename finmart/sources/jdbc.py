"""Loading the star schema into a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

LOAD_ORDER = ("dim_date", "dim_branch", "dim_account", "dim_customer", "fact_transactions")


def write_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_rows: int = 10_000,
) -> None:
    """Replace the rows of a table and keep its definition.

    `connections` bounds the parallel writers, which the database has to bear.
    Emptying and filling are two transactions: a reader may see the gap.
    """
    (
        df.write.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .mode("overwrite")
        .save()
    )


def load_star(tables: Mapping[str, DataFrame], url: str, **options) -> list[str]:
    """Load all five tables, dimensions before the fact; returns their names."""
    for name in LOAD_ORDER:
        write_jdbc(tables[name], name, url, **options)
    return list(LOAD_ORDER)
