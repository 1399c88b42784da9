"""The bank feeds as views of TPC-H-like tables, and a warehouse built from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from finmart.operators.quality import valid_transactions
from finmart.plans.jobs import Period, write_star
from finmart.sources.lake import Lake
from finmart.sources.scratch import materialize, scratch_path

PERIOD = Period(end=date(2026, 6, 30), days=90)
THRESHOLD = 100_000  # amounts in these tables reach about 105,000



def _padded(number: str, width: int) -> str:
    """The digits of a number with zeros in front up to `width`; longer ones stay whole."""
    digits = f"cast({number} as string)"
    return f"lpad({digits}, cast(greatest(length({digits}), {width}) as int), '0')"


# The remainders give every change class its customers: some come with the second
# snapshot, some are missing from it, some moved, and some of those changed segment.
_SNAPSHOT = f"""
select 'CUST' || {_padded("c_custkey", 6)} as customer_id, c_name as name,
       {{segment}} as segment, n_name as province,
       case when c_acctbal < 4500 then 'basic' when c_acctbal < 8350 then 'standard'
            else 'enhanced' end as kyc_level,
       date '{{day}}' as snapshot_date
from {{{{customer}}}} join {{{{nation}}}} on {{nation}} = n_nationkey
where c_custkey % 50 <> {{absent}}
"""
_AS_IS = {"segment": "c_mktsegment", "nation": "c_nationkey"}
_DRIFTED = {
    "segment": "case when c_custkey % 40 = 0 then 'RECLASSIFIED' else c_mktsegment end",
    "nation": "(case when c_custkey % 20 = 0 then (c_nationkey + 1) % 25 else c_nationkey end)",
}

# Spark and DuckDB both run these. Tables are in braces.
VIEWS = {
    "raw_branches": f"""
select 'BR' || {_padded("n_nationkey", 3)} as branch_code,
       n_name || ' Branch' as branch_name, n_name as province, r_name as region
from {{nation}} join {{region}} on n_regionkey = r_regionkey
""",
    "raw_accounts": f"""
select 'ACC' || {_padded("p_partkey", 7)} as account_id,
       'CUST' || {_padded("p_partkey % 150", 6)} as customer_id,
       case when p_size <= 30 then 'savings' when p_size <= 45 then 'current'
            else 'fixed_deposit' end as product_type,
       'THB' as currency,
       '202' || cast(p_size % 6 as string) || '-01-15' as opened_date,
       case when p_size <= 42 then 'active' when p_size <= 47 then 'dormant'
            else 'closed' end as status
from {{part}}
""",
    "snap1": _SNAPSHOT.format(day="2026-04-02", absent=3, **_AS_IS),
    "snap2": _SNAPSHOT.format(day="2026-05-17", absent=7, **_DRIFTED),
    "raw_txns": f"""
select 'TXN' || {_padded("l_orderkey", 8)} || '-' || cast(l_linenumber as string)
           as txn_id,
       cast(date '2026-04-02' + cast((year(l_shipdate) * 372 + month(l_shipdate) * 31
                                      + day(l_shipdate)) % 90 as int) as string) as txn_date,
       case when l_partkey % 101 = 0 then null
            else 'ACC' || {_padded("l_partkey", 7)} end as account_id,
       case when l_orderkey % 97 = 0 then null
            else 'CUST' || {_padded("o_custkey", 6)} end as customer_id,
       'BR' || {_padded("l_suppkey % 25", 3)} as branch_code,
       case when l_returnflag = 'N'
            then (case when l_linenumber % 2 = 0 then 'mobile' else 'internet' end)
            else (case when l_linenumber % 2 = 0 then 'branch' else 'atm' end) end as channel,
       case l_linenumber % 5 when 0 then 'deposit' when 1 then 'withdrawal'
            when 2 then 'transfer_in' when 3 then 'transfer_out' else 'payment' end as txn_type,
       l_returnflag <> 'N' as is_cash,
       cast(case when l_orderkey % 83 = 0 then null when l_orderkey % 89 = 0 then -l_extendedprice
                 else l_extendedprice end as decimal(15,2)) as amount,
       cast(case when l_linenumber % 5 in (3, 4) then l_tax else 0 end as decimal(15,2)) as fee
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
""",
}

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


# Per application: the tables, whose files are listed once, the written feeds, and
# the written warehouses.
_tables: dict[tuple[str, str, str], DataFrame] = {}
_feeds: dict[tuple[str, str], DataFrame] = {}
_warehouses: dict[tuple[str, str], tuple[Lake, dict[str, DataFrame]]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _tables[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in TABLES if f"{{{t}}}" in VIEWS[name]]
    return spark.sql(VIEWS[name], **{t: table(spark, sf_dir, t) for t in used})


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction feed, written on first use and then read.

    A feed lies in files before the gate sees it; the view is how it gets there. Rows are
    written where the join leaves them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _feeds:
        _feeds[key] = materialize(view(spark, sf_dir, "raw_txns"), "raw-transactions")
    return _feeds[key]


def _warehouse(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, DataFrame]]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        lake = Lake(scratch_path(spark, "warehouse"))
        star = write_star(
            spark,
            lake,
            view(spark, sf_dir, "raw_branches"),
            view(spark, sf_dir, "raw_accounts"),
            [view(spark, sf_dir, name) for name in ("snap1", "snap2")],
            valid_transactions(transactions(spark, sf_dir)),
            PERIOD,
        )
        _warehouses[key] = lake, star
    return _warehouses[key]


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema of the tables in `sf_dir`, written on first use and then read.

    Reports start from the written warehouse, as they do in the jobs.
    """
    return _warehouse(spark, sf_dir)[1]


def warehouse_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Where that star schema lies."""
    return _warehouse(spark, sf_dir)[0]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Have the feed and the warehouse of `sf_dir` written again on their next use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    _feeds.pop(key, None)
    _warehouses.pop(key, None)
