from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from compare import spark_bag
from finmart import cli, schemas
from finmart.plans import analytics, jobs
from finmart.sources import lake as files
from finmart.sources import seed, versions
from finmart.sources.lake import Lake
from finmart.sources.versions import Version

CUSTOMERS, ACCOUNTS, TRANSACTIONS = 400, 600, 6000


@pytest.fixture(scope="module")
def lake(tmp_path_factory) -> Lake:
    return Lake(str(tmp_path_factory.mktemp("lake")))


@pytest.fixture(scope="module")
def run(spark, lake):
    """All four jobs on a generated feed, and what they reported."""
    jobs.seed_raw(spark, lake, CUSTOMERS, ACCOUNTS, TRANSACTIONS)
    return {
        "stage": jobs.raw_to_staging(spark, lake),
        "load": jobs.staging_to_warehouse(spark, lake),
        "report": jobs.regulatory_reports(spark, lake),
    }


def test_the_gate_finds_the_injected_faults(run):
    counts = run["stage"]
    assert {name: n for name, n in counts.items() if n} == {
        "total": TRANSACTIONS + 180,
        "valid": TRANSACTIONS,
        "rejected": 180,
        "null_required_field": 60,
        "negative_amount": 60,
        "duplicate_txn_id": 60,
    }


def test_the_star_has_the_expected_rows(spark, lake, run):
    counts = run["load"]
    assert counts["dim_date"] == 90
    assert counts["dim_branch"] == 8
    assert counts["dim_account"] == ACCOUNTS
    assert counts["fact_transactions"] == TRANSACTIONS
    star = jobs.read_star(spark, lake)
    assert star["dim_customer"].where("is_current").count() == CUSTOMERS
    moved = counts["dim_customer"] - CUSTOMERS
    assert 0.02 * CUSTOMERS < moved < 0.09 * CUSTOMERS
    unresolved = star["fact_transactions"].where(
        "date_key is null or customer_key is null or account_key is null or branch_key is null"
    )
    assert unresolved.count() == 0


def test_the_reports_are_there(spark, lake, run):
    hits = run["report"]["ctr"]
    assert 5 < hits < 60  # 0.39 of the transactions are cash, 0.01 of those large
    ctr = files.read_csv(spark, lake.report("ctr"), {"txn_id": "string"})
    assert ctr.count() == hits
    assert len(list(Path(lake.report("ctr")).glob("report_month=2026-0*/*.csv"))) == 3
    assert len(list(Path(lake.report("monthly_summary")).glob("report_month=2026-0*/*.csv"))) == 3
    assert len(list(Path(lake.report("monthly_summary_file")).glob("*.csv"))) == 1
    summary = files.read_csv(spark, lake.report("monthly_summary_file"), schemas.MONTHLY_SUMMARY)
    groups = run["report"]["monthly_summary"]  # months x branches x products x types
    assert summary.count() == groups and 340 < groups <= 3 * 8 * 3 * 5
    assert summary.agg(F.sum("txn_count")).first()[0] == TRANSACTIONS


def test_reports_of_a_part_of_the_days(spark, lake, run):
    """A report of May, under another threshold, leaves April and June as they were."""

    def by_month(name):
        tree = files.read_csv(spark, lake.report(name), {"txn_type": "string", "report_month": "string"})
        return dict(tree.groupBy("report_month").count().collect())

    before = {name: by_month(name) for name in ("ctr", "monthly_summary")}
    part = jobs.regulatory_reports(
        spark, lake, threshold=0, first=date(2026, 5, 9), last=date(2026, 5, 20)
    )
    after = {name: by_month(name) for name in ("ctr", "monthly_summary")}
    assert 110 < part["monthly_summary"] <= 8 * 3 * 5 and after["monthly_summary"] == before["monthly_summary"]
    # The whole month, although only some of its days were given.
    assert part["ctr"] == after["ctr"]["2026-05"] > 20 * before["ctr"]["2026-05"]
    assert {**after["ctr"], "2026-05": None} == {**before["ctr"], "2026-05": None}
    assert len(before["ctr"]) == 3
    jobs.regulatory_reports(spark, lake, first=date(2026, 5, 1), last=date(2026, 5, 31))
    assert by_month("ctr") == before["ctr"]
    whole = files.read_csv(spark, lake.report("monthly_summary_file"), schemas.MONTHLY_SUMMARY)
    assert whole.count() == sum(before["monthly_summary"].values())


SQL = {
    "cash_by_branch_month": """
        select year, month, branch_name, is_cash, count(*) as txn_count,
               sum(amount) as total_amount
        from fact_transactions join dim_date using (date_key) join dim_branch using (branch_key)
        group by year, month, branch_name, is_cash""",
    "top_customers": """
        select customer_id, name, segment, province, count(*) as txn_count,
               sum(amount) as total_amount
        from fact_transactions join dim_customer using (customer_key) where is_current
        group by customer_id, name, segment, province
        order by total_amount desc, customer_id limit 10""",
    "product_mix_by_region": """
        select region, product_type, count(*) as txn_count, avg(amount) as avg_amount
        from fact_transactions join dim_branch using (branch_key)
             join dim_account using (account_key)
        group by region, product_type""",
    "weekend_cash": """
        select is_weekend, count(*) as cash_txn_count, sum(amount) as cash_total_amount
        from fact_transactions join dim_date using (date_key) where is_cash
        group by is_weekend""",
}


@pytest.mark.parametrize("name", SQL)
def test_sql_on_the_star_equals_the_functions(spark, lake, run, name):
    assert set(jobs.register_star(spark, lake)) == set(run["load"])
    star = jobs.read_star(spark, lake)
    dims = {
        "cash_by_branch_month": ("dim_date", "dim_branch"),
        "top_customers": ("dim_customer",),
        "product_mix_by_region": ("dim_branch", "dim_account"),
        "weekend_cash": ("dim_date",),
    }[name]
    ours = getattr(analytics, name)(star["fact_transactions"], *[star[dim] for dim in dims])
    assert spark_bag(ours) == spark_bag(spark.sql(SQL[name]))


def test_jobs_can_run_again(spark, lake, run):
    assert jobs.raw_to_staging(spark, lake) == run["stage"]
    assert jobs.staging_to_warehouse(spark, lake) == run["load"]


def test_an_account_given_twice_is_noticed(spark, lake, run, tmp_path):
    copy = Lake(str(tmp_path))
    feeds = ("branches", "accounts", "customers_snapshot1", "customers_snapshot2", "transactions")
    for feed in feeds:
        files.write_parquet(spark.read.parquet(lake.staging(feed)), copy.staging(feed))
    jobs.staging_to_warehouse(spark, copy)
    published = {name: spark_bag(df) for name, df in jobs.read_star(spark, copy).items()}
    accounts = files.read_parquet(spark, lake.staging("accounts"), schemas.RAW_ACCOUNTS)
    files.write_parquet(accounts.unionByName(accounts.limit(1)), copy.staging("accounts"))
    with pytest.raises(ValueError, match="in their feed twice"):
        jobs.staging_to_warehouse(spark, copy)
    # What was published before is untouched.
    assert published == {name: spark_bag(df) for name, df in jobs.read_star(spark, copy).items()}


@pytest.fixture
def loaded(spark, lake, run, tmp_path) -> Lake:
    """A warehouse of the first snapshot only, with the other feeds staged."""
    copy = Lake(str(tmp_path))
    for feed in ("branches", "accounts", "customers_snapshot1", "transactions"):
        files.write_parquet(spark.read.parquet(lake.staging(feed)), copy.staging(feed))
    feed = files.read_csv(spark, lake.raw("customers_snapshot2"), schemas.RAW_CUSTOMERS)
    files.write_csv(feed, copy.raw("customers_snapshot2"))
    jobs.staging_to_warehouse(spark, copy, ["customers_snapshot1"])
    return copy


def bags(star):
    return {name: spark_bag(df) for name, df in star.items()}


def test_merging_a_snapshot_equals_loading_both(spark, lake, run, loaded, monkeypatch):
    jobs.staging_to_warehouse(spark, lake)
    before = jobs.read_star(spark, loaded)
    seen = bags(before)
    monkeypatch.setattr(cli, "get_spark_session", lambda *_: spark)
    cli.main(["merge", "--lake", loaded.base, "customers_snapshot2"])
    after = jobs.read_star(spark, loaded)
    assert bags(after) == bags(jobs.read_star(spark, lake))
    # Who began to read before the merge still reads what there was.
    assert bags(before) == seen and seen["dim_customer"] != bags(after)["dim_customer"]
    version = versions.current(spark, loaded)
    assert version.number == 2 and len(set(version.fact.values())) == 2
    april = {month: folder for month, folder in version.fact.items() if month == 202604}
    assert april[202604].startswith("v000001") and version.tables["dim_account"].startswith("v000001")
    # Only the folders of the wanted days are read, whatever version wrote them.
    may = jobs.read_star(spark, loaded, date(2026, 5, 1), date(2026, 5, 31))["fact_transactions"]
    whole = jobs.read_star(spark, lake)["fact_transactions"]
    assert spark_bag(may) == spark_bag(whole.where("date_key between 20260501 and 20260531"))
    with pytest.raises(PySparkException, match="not newer"):
        # The first one again would undo what the second one changed.
        files.write_csv(
            files.read_csv(spark, lake.raw("customers_snapshot1"), schemas.RAW_CUSTOMERS),
            loaded.raw("customers_snapshot1"),
        )
        jobs.merge_snapshot(spark, loaded, "customers_snapshot1")
    assert versions.current(spark, loaded) == version


def test_a_failed_load_leaves_the_old_version(spark, loaded, monkeypatch):
    published = bags(jobs.read_star(spark, loaded))
    write = files.write_fact

    def dies(fact, path):
        write(fact.limit(100), path)
        raise OSError("no space left")

    monkeypatch.setattr(files, "write_fact", dies)
    for job in (jobs.staging_to_warehouse, jobs.merge_snapshot):
        with pytest.raises(OSError):
            job(spark, loaded, "customers_snapshot2" if job is jobs.merge_snapshot else ["customers_snapshot1"])
        assert bags(jobs.read_star(spark, loaded)) == published


@pytest.mark.parametrize(
    ("fault", "message"),
    [
        (lambda fact: fact.union(fact.limit(1)), "6001 rows for 6000"),
        (lambda fact: fact.where("txn_id not like '%7'"), "5[0-9]* rows for 6000"),
        (lambda fact: fact.withColumn("account_key", F.lit(601)), "account_key 601"),
    ],
)
def test_a_fact_that_does_not_agree_is_not_published(spark, loaded, monkeypatch, fault, message):
    version = versions.current(spark, loaded)
    write = files.write_fact
    monkeypatch.setattr(files, "write_fact", lambda fact, path: write(fault(fact), path))
    with pytest.raises(ValueError, match=message):
        jobs.staging_to_warehouse(spark, loaded, ["customers_snapshot1"])
    assert versions.current(spark, loaded) == version


def test_versions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert versions.current(spark, lake) == Version()
    with pytest.raises(ValueError, match="no warehouse has been published"):
        jobs.read_star(spark, lake)
    with pytest.raises(ValueError, match="load one first"):
        jobs.merge_snapshot(spark, lake, "x")
    first = versions.current(spark, lake).following()
    rival = versions.current(spark, lake).following()
    first.fact[None] = first.folder("fact_transactions")
    versions.publish(spark, lake, first)
    assert versions.current(spark, lake) == first
    with pytest.raises(RuntimeError, match="another load"):
        versions.publish(spark, lake, rival)
    assert versions.current(spark, lake) == first


def test_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "get_spark_session", lambda *_: spark)
    base = ["--lake", str(tmp_path)]
    cli.main(["seed", *base, "--customers", "50", "--accounts", "60", "--transactions", "200"])
    cli.main(["stage", *base])
    cli.main(["load", *base])
    cli.main(["report", *base, "--threshold", "100"])
    cli.main(["sql", *base, "select count(*) as n from fact_transactions where fee >= 0"])
    cli.main(["sql", *base, "select 1 as n from dim_branch", "--output", f"{tmp_path}/out"])
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 8
    output = capsys.readouterr().out
    assert "|200|" in output
    assert "'valid': 200" in output and "'fact_transactions': 200" in output


# Generated feeds.


def test_a_feed_does_not_depend_on_its_layout(spark):
    def feed(ids):
        return seed.generate_transactions(ids, 50, 20, ["B1", "B2"], date(2026, 4, 2), 90)

    ids = seed.rows(spark, 500)
    assert sorted(feed(ids).collect()) == sorted(feed(ids.repartition(7)).collect())


def test_shares_of_a_feed(spark):
    n = 20_000
    df = seed.generate_transactions(
        seed.rows(spark, n), 300, 200, seed.branch_codes(), date(2026, 4, 2), 90
    ).cache()
    share = {
        name: df.where(condition).count() / n
        for name, condition in {
            "cash": "is_cash",
            "counter cash": "is_cash and txn_type in ('deposit', 'withdrawal')",
            "large": "amount >= 2000000",
            "fee": "fee > 0",
            "cash by phone": "is_cash and channel in ('mobile', 'internet')",
            "not cash at atm": "not is_cash and channel = 'atm'",
        }.items()
    }
    assert share["cash"] == pytest.approx(0.39, abs=0.02)
    assert share["counter cash"] == pytest.approx(0.36, abs=0.02)
    assert share["large"] == pytest.approx(0.0039, abs=0.002)
    assert share["fee"] == pytest.approx(0.4, abs=0.02)
    assert share["cash by phone"] == share["not cash at atm"] == 0
    bounds = df.agg(
        F.min("txn_date"), F.max("txn_date"), F.min("amount"), F.countDistinct("txn_id")
    ).first()
    assert bounds[:2] == ("2026-04-02", "2026-06-30")
    assert bounds[2] >= 100 and bounds[3] == n
    assert not df.where("amount > 50000 and amount < 2000000").count()
    df.unpersist()


def test_transactions_belong_to_the_owner_of_their_account(spark):
    accounts = seed.generate_accounts(seed.rows(spark, 300), 200, date(2026, 4, 2))
    feed = seed.generate_transactions(
        seed.rows(spark, 1000), 300, 200, ["B1"], date(2026, 4, 2), 90
    )
    assert feed.join(accounts, ["account_id", "customer_id"], "left_anti").count() == 0
    oldest, youngest = accounts.agg(F.min("opened_date"), F.max("opened_date")).first()
    assert date.fromisoformat(oldest) >= date(2026, 4, 2) - timedelta(days=5 * 365)
    assert date.fromisoformat(youngest) <= date(2026, 4, 2) - timedelta(days=30)


def test_drift(spark):
    n = 10_000
    first = seed.generate_customers(seed.rows(spark, n), date(2026, 4, 2))
    second = seed.apply_customer_drift(first, date(2026, 5, 17))
    pairs = first.alias("a").join(second.alias("b"), "customer_id")
    moved = pairs.where("a.province <> b.province").count()
    regraded = pairs.where("a.segment <> b.segment")
    assert moved / n == pytest.approx(0.05, abs=0.01)
    assert regraded.count() / moved == pytest.approx(0.5, abs=0.1)
    assert regraded.where("a.province = b.province").count() == 0
    assert pairs.where("a.name <> b.name or a.kyc_level <> b.kyc_level").count() == 0
    shares = {row.segment: row["count"] / n for row in first.groupBy("segment").count().collect()}
    assert shares == pytest.approx(seed.SEGMENTS, abs=0.02)


def test_ids_grow_beyond_their_width(spark):
    ids = spark.createDataFrame([(7,), (123456789012,)], "row bigint")
    found = seed.generate_customers(ids, date(2026, 4, 2)).select("customer_id").collect()
    assert {row.customer_id for row in found} == {"CUST000007", "CUST123456789012"}


def test_draws_of_too_wide_a_range_fail(spark):
    with pytest.raises(ValueError, match="range of a draw"):
        seed.generate_accounts(seed.rows(spark, 1), 2**31, date(2026, 4, 2))
