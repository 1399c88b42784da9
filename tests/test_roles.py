"""The feeds as views of tables with more rows than the padding has digits."""

from __future__ import annotations

import pytest
from finmart.plans import roles


@pytest.mark.parametrize(("number", "width", "expected"), [(7, 3, "007"), (123, 3, "123"), (12345, 3, "12345")])
def test_padding_never_cuts(spark, number, width, expected):
    import duckdb

    sql = f"select {roles._padded(str(number), width)}"
    assert spark.sql(sql).first()[0] == duckdb.sql(sql).fetchall()[0][0] == expected


def test_large_keys_stay_apart(spark, tmp_path):
    """Counts of the raw keys, not of what the views make of them."""
    base = str(tmp_path)
    customers, parts, orders = 10_000_000, 100_000_000, 1_000_000_000
    n = spark.range(60)
    n.selectExpr(
        f"if(id % 2 = 0, id, {customers} + id * 10 + 1) as c_custkey", "concat('C', id) as c_name",
        "cast(id % 25 as int) as c_nationkey", "cast(id * 100 as double) as c_acctbal", "'BUILDING' as c_mktsegment",
    ).write.parquet(f"{base}/customer.parquet")
    n.selectExpr(f"{parts} + id * 7 as p_partkey", "cast(id % 50 as int) as p_size").write.parquet(f"{base}/part.parquet")
    n.selectExpr(
        f"{orders} * (1 + id % 2) + id as o_orderkey", f"if(id % 2 = 0, id, {customers} + id * 10 + 1) as o_custkey"
    ).write.parquet(f"{base}/orders.parquet")
    n.selectExpr(
        f"{orders} * (1 + id % 2) + id as l_orderkey", f"{parts} + id * 7 as l_partkey", "id as l_suppkey",
        "1 as l_linenumber", "cast(100 + id as double) as l_extendedprice", "0.0D as l_tax", "'N' as l_returnflag",
        "timestamp'1995-05-05' as l_shipdate",
    ).write.parquet(f"{base}/lineitem.parquet")
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name", "0 as n_regionkey").write.parquet(f"{base}/nation.parquet")
    spark.range(1).selectExpr("cast(id as int) as r_regionkey", "'R' as r_name").write.parquet(f"{base}/region.parquet")

    def distinct(view: str, key: str) -> int:
        return roles.view(spark, base, view).select(key).distinct().count()

    def raw(table: str, key: str, condition: str = "true") -> int:
        return roles.table(spark, base, table).where(condition).select(key).distinct().count()

    assert distinct("raw_txns", "txn_id") == raw("lineitem", "l_orderkey") == 60
    assert distinct("raw_accounts", "account_id") == raw("part", "p_partkey") == 60
    assert distinct("snap1", "customer_id") == raw("customer", "c_custkey", "c_custkey % 50 <> 3")
    assert distinct("snap2", "customer_id") == raw("customer", "c_custkey", "c_custkey % 50 <> 7")
    ids = roles.view(spark, base, "raw_txns").select("customer_id").distinct()
    known = roles.view(spark, base, "snap1").select("customer_id")
    assert ids.join(known, "customer_id", "left_semi").count() > 50


def test_the_feed_is_written_where_the_join_leaves_it(spark, sf_dir, monkeypatch):
    """No row is sorted and moved once more only to even out the files."""
    plans = []

    def written(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(roles, "materialize", written)
    monkeypatch.setattr(roles, "_feeds", {})
    feed = roles.transactions(spark, sf_dir)
    assert "Rebalance" not in plans[0] and "Repartition" not in plans[0]
    assert feed.count() == roles.view(spark, sf_dir, "raw_txns").count() > 0
