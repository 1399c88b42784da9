from __future__ import annotations

from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from compare import spark_bag
from finmart import schemas
from finmart.operators import quality
from finmart.sources import jdbc, scratch, session
from finmart.sources import lake as files
from finmart.sources.lake import Lake
from finmart.sources.scratch import materialize, scratch_path, scratch_root
from plans import plan_of, settings
from rows import booked, frame, txn

CTR = {"txn_id": "string", "date": "date", "report_month": "string", "amount": schemas.MONEY}


def test_zones():
    lake = Lake("s3a://lake")
    assert lake.raw("accounts") == "s3a://lake/raw/accounts"
    assert lake.staging("accounts") == "s3a://lake/staging/accounts"
    assert lake.warehouse("dim_date") == "s3a://lake/warehouse/dim_date"
    assert lake.report("ctr") == "s3a://lake/reports/ctr"


def test_csv_cells(spark, tmp_path):
    (tmp_path / "feed.csv").write_text(
        ",".join(schemas.RAW_TRANSACTIONS)
        + "\nT1,2026-04-05,A1,C1,B1,atm,deposit,true,12.50,0\n"
        + "T2,2026-04-05,,C1,B1,atm,deposit,maybe,many,\n"
        + "T3,2026-04-05,A1,C1,B1,atm,deposit,false,NaN,0\n"
    )
    path = str(tmp_path / "feed.csv")
    feed = files.read_csv(spark, path, schemas.RAW_TRANSACTIONS)
    rows = {row.txn_id: row for row in feed.collect()}
    assert rows["T1"].amount == 12.5 and rows["T1"].is_cash is True
    assert (rows["T2"].account_id, rows["T2"].is_cash, rows["T2"].amount) == (None, None, None)
    assert rows["T3"].amount != rows["T3"].amount
    tagged = quality.tag_transactions(feed).select("txn_id", "reject_reason").collect()
    assert {row.txn_id: row.reject_reason for row in tagged} == {
        "T1": None,
        "T2": "null_required_field",
        "T3": "invalid_amount",
    }


def test_corrupt_lines_are_kept_on_request(spark, tmp_path):
    (tmp_path / "feed.csv").write_text(
        ",".join(schemas.RAW_TRANSACTIONS)
        + "\nT1,2026-04-05,A1,C1,B1,atm,deposit,maybe,12.50,0\n"
        + "T2,2026-04-05,A1,C1,B1,atm,deposit,true,12.50,0\n"
    )
    feed = files.read_csv(spark, str(tmp_path / "feed.csv"), schemas.RAW_TRANSACTIONS, "_line")
    tagged = quality.tag_transactions(feed, corrupt_column="_line").collect()
    assert {row.txn_id: row.reject_reason for row in tagged} == {"T1": "malformed_row", "T2": None}
    # Also for those who look at other columns than the one with the bad cell.
    valid = quality.valid_transactions(feed, corrupt_column="_line")
    assert [row.txn_id for row in valid.select("txn_id").collect()] == ["T2"]
    reasons = quality.tag_transactions(feed, corrupt_column="_line").groupBy("reject_reason")
    assert dict(reasons.count().collect()) == {"malformed_row": 1, None: 1}


def test_gate_sides_are_tables_of_their_own(spark, tmp_path):
    raw = frame(
        spark,
        schemas.RAW_TRANSACTIONS,
        *[txn(), txn(), txn(txn_id="T2", amount=-1.5), txn(txn_id="T3")],
    )
    places = str(tmp_path / "transactions"), str(tmp_path / "_rejects")
    files.write_gate(*quality.split_transactions(raw), *places)
    # A plain read gives valid rows only, with exact money.
    plain = spark.read.parquet(places[0])
    assert spark_bag(plain) == spark_bag(quality.valid_transactions(raw))
    assert dict(plain.dtypes)["amount"] == dict(plain.dtypes)["fee"] == schemas.MONEY
    assert spark_bag(files.read_valid(spark, places[0])) == spark_bag(plain)
    rejects = files.read_rejects(spark, places[1])
    assert spark_bag(rejects) == spark_bag(quality.rejected_transactions(raw))


def test_a_gate_without_rejects_reads_empty(spark, tmp_path):
    raw = frame(spark, schemas.RAW_TRANSACTIONS, txn())
    files.write_gate(*quality.split_transactions(raw), str(tmp_path / "valid"), str(tmp_path / "rejects"))
    assert files.read_rejects(spark, str(tmp_path / "rejects")).count() == 0


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_each_month_has_the_files_it_needs(spark, tmp_path, coalesce):
    """Month 1 has 2,500 rows, month 2 has 250, month 3 exactly 600, others none."""
    place = "cast(id * 7919 % 3350 as int)"
    month = "case when id < 2500 then '2026-01' when id < 2750 then '2026-02' else '2026-03' end"
    rows = spark.range(3350).selectExpr(f"{month} as month", f"{place} as place", "id")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled=coalesce):
        n = files.write_report(rows, str(tmp_path / "r"), "month", ["place"], file_rows=300)
    assert n == 3350
    found = {}
    for folder in (tmp_path / "r").glob("month=*"):
        parts = [part.read_text().splitlines()[1:] for part in sorted(folder.glob("part-*"))]
        found[folder.name[-2:]] = [len(part) for part in parts]
        places = [int(line.split(",")[0]) for part in parts for line in part]
        assert places == sorted(places)
    assert found == {"01": [300] * 8 + [100], "02": [250], "03": [300, 300]}


def test_a_report_of_some_months_keeps_the_others(spark, tmp_path):
    path = tmp_path / "r"

    def written():
        return {f.name: sorted(p.read_text() for p in f.glob("part-*")) for f in path.glob("report_month=*")}

    files.write_report(hits(spark), str(path), "report_month", ["date"])
    before = written()
    part = hits(spark).where("report_month = '2026-05' and txn_id <> 'T31'")
    n = files.write_report(part, str(path), "report_month", ["date"], ["2026-05"])
    after = written()
    assert n == part.count() and after.keys() == before.keys()
    assert {name for name in after if after[name] != before[name]} == {"report_month=2026-05"}
    # A month that has no row any more is empty, and not what it was.
    assert files.write_report(part.limit(0), str(path), "report_month", ["date"], ["2026-05"]) == 0
    again = files.read_partitioned_csv(spark, str(path), CTR, "report_month")
    assert spark_bag(again) == spark_bag(hits(spark).where("report_month is distinct from '2026-05'"))


@pytest.fixture
def stored_fact(spark, tmp_path):
    days = [20260405, 20260405, 20260430, 20260501, 20260620, None]
    fact = frame(
        spark,
        schemas.FACT_TRANSACTIONS,
        *[booked(txn_id=f"T{i}", date_key=day) for i, day in enumerate(days)],
    )
    path = str(tmp_path / "fact")
    files.write_fact(fact, path)
    return fact, path


def test_fact_comes_back(spark, stored_fact):
    fact, path = stored_fact
    again = files.read_fact(spark, path)
    assert spark_bag(again) == spark_bag(fact)
    assert dict(again.dtypes) == schemas.FACT_TRANSACTIONS


def test_fact_of_a_period_skips_other_months(spark, stored_fact):
    _, path = stored_fact
    part = files.read_fact(spark, path, date(2026, 4, 30), date(2026, 5, 31))
    assert sorted(row.txn_id for row in part.collect()) == ["T2", "T3"]
    plan = plan_of(part)
    assert "(txn_month#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(date_key,20260430)" in plan
    open_ended = files.read_fact(spark, path, first=date(2026, 5, 1))
    assert sorted(row.txn_id for row in open_ended.collect()) == ["T3", "T4"]


def test_fact_files_are_sorted_by_day(spark, tmp_path):
    i = F.col("id")
    fact = spark.range(2000).select(
        *[F.lit(1).cast(kind).alias(name) for name, kind in schemas.FACT_TRANSACTIONS.items()
          if name != "date_key"],
        (F.lit(20260401) + (i * 7919) % 30).cast("int").alias("date_key"),
    )
    files.write_fact(fact.select(*schemas.FACT_TRANSACTIONS), str(tmp_path / "fact"))
    for file in (tmp_path / "fact").rglob("*.parquet"):
        keys = [row.date_key for row in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert keys == sorted(keys)


def hits(spark, n: int = 60):
    i = F.col("id")
    day = F.date_add(F.lit(date(2026, 4, 1)), (i % 90).cast("int"))
    return spark.range(0, n, 1, 6).select(
        F.concat(F.lit("T"), i.cast("string")).alias("txn_id"),
        F.when(i % 20 != 0, day).alias("date"),
        F.when(i % 20 != 0, F.date_format(day, "yyyy-MM")).alias("report_month"),
        i.cast(schemas.MONEY).alias("amount"),
    )


def test_partitioned_csv_comes_back_with_its_null_month(spark, tmp_path):
    path = str(tmp_path / "ctr")
    files.write_partitioned_csv(hits(spark), path, "report_month")
    again = files.read_partitioned_csv(spark, path, CTR, "report_month")
    assert dict(again.dtypes) == CTR
    assert spark_bag(again) == spark_bag(hits(spark))


def test_one_sorted_file_per_month(spark, tmp_path):
    path = tmp_path / "ctr"
    files.write_report(hits(spark, 300), str(path), "report_month", ["date", "txn_id"])
    months = sorted(path.glob("report_month=2*"))
    assert [month.name[-7:] for month in months] == ["2026-04", "2026-05", "2026-06"]
    for month in months:
        (file,) = month.glob("*.csv")
        lines = [line.split(",") for line in file.read_text().splitlines()]
        assert lines[0] == ["txn_id", "date", "amount"]
        assert lines[1:] == sorted(lines[1:], key=lambda cells: (cells[1], cells[0]))
    again = files.read_partitioned_csv(spark, str(path), CTR, "report_month")
    assert spark_bag(again) == spark_bag(hits(spark, 300))


def test_scratch_is_where_the_session_says(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    again = materialize(spark.range(5), "five")
    assert again.count() == 5
    assert any(Path(root, "finmart").glob("five-*"))


class NoSetting:
    def get(self, key, default=None):
        return default


@pytest.mark.parametrize(
    ("master", "checkpoint_dir", "root"),
    [("yarn", "hdfs://shared/dir/", "hdfs://shared/dir"), ("yarn", None, None)],
)
def test_scratch_without_the_setting(master, checkpoint_dir, root):
    context = SimpleNamespace(
        master=master, applicationId="app", getCheckpointDir=lambda: checkpoint_dir
    )
    session_like = SimpleNamespace(conf=NoSetting(), sparkContext=context)
    if root:
        assert scratch_root(session_like) == root
    else:
        with pytest.raises(RuntimeError, match="all executors share"):
            scratch_root(session_like)


def test_scratch_of_a_local_master_is_one_folder(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch.tempfile, "mkdtemp", lambda prefix: f"{tmp_path}/{prefix}")
    context = SimpleNamespace(
        master="local[2]", applicationId=str(tmp_path), getCheckpointDir=lambda: None
    )
    session_like = SimpleNamespace(conf=NoSetting(), sparkContext=context)
    assert scratch_root(session_like) == scratch_root(session_like) == f"{tmp_path}/finmart-"


class Recorder:
    """Stands in for a frame and its writer and keeps what it was told."""

    def __init__(self, log):
        self.log, self.settings = log, {}
        self.write = self

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **values):
        self.settings.update(values)
        return self

    def mode(self, name):
        self.settings["mode"] = name
        return self

    def save(self):
        self.log.append(self.settings)


def test_jdbc_load_keeps_the_tables_and_their_order():
    log = []
    tables = {name: Recorder(log) for name in reversed(jdbc.LOAD_ORDER)}
    jdbc.load_star(tables, "jdbc:x", properties={"user": "u", "driver": "d"}, connections=3)
    assert [settings["dbtable"] for settings in log] == [
        "dim_date",
        "dim_branch",
        "dim_account",
        "dim_customer",
        "fact_transactions",
    ]
    assert log[0] == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "dim_date",
        "user": "u",
        "driver": "d",
        "truncate": True,
        "mode": "overwrite",
        "numPartitions": 3,
        "batchsize": 10_000,
    }


def test_object_store_options():
    plain = session.object_store_options("http://store:1")
    assert plain["spark.hadoop.fs.s3a.endpoint"] == "http://store:1"
    assert not any("credentials" in key or "key" in key.rsplit(".")[-1] for key in plain)
    keyed = session.object_store_options("http://store:1", "id", "word")
    assert keyed["spark.hadoop.fs.s3a.access.key"] == "id"


@pytest.mark.parametrize(
    ("path", "factory"),
    [
        ("s3a://bucket/lake", "S3ACommitterFactory"),
        ("abfs://box@account/lake", "AzureManifestCommitterFactory"),
        ("abfss://box@account/lake", "AzureManifestCommitterFactory"),
        ("gs://bucket/lake", "ManifestCommitterFactory"),
        ("hdfs://host/lake", None),
        ("file:///lake", None),
        ("/lake", None),
    ],
)
def test_committers_by_scheme(path, factory):
    found = session.commit_options(path)
    if factory is None:
        assert found == {}
        return
    scheme = path.split(":")[0]
    assert found[f"spark.hadoop.mapreduce.outputcommitter.factory.scheme.{scheme}"].endswith(f".{factory}")
    assert found["spark.sql.sources.commitProtocolClass"].endswith("PathOutputCommitProtocol")
    assert ("spark.hadoop.fs.s3a.committer.name" in found) == (scheme == "s3a")


def test_task_sizes_follow_the_input():
    def sizes(n_bytes):
        options = session.options_for(n_bytes)
        return tuple(
            int(options[key])
            for key in (
                "spark.sql.files.maxPartitionBytes",
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            )
        )

    for n_bytes in (10**6, 10**9, 2**40, 100 * 2**40):
        split, tasks = sizes(n_bytes)
        assert split == 128 * 2**20
        assert tasks == 200 or 128 * 2**20 <= n_bytes / tasks <= 256 * 2**20
        assert session.options_for(n_bytes)["spark.sql.autoBroadcastJoinThreshold"] == str(10 * 2**20)
