"""Scratch tables: written once, erased when asked, and nothing else with them."""

from __future__ import annotations

from pathlib import Path

import pytest
from finmart.sources import scratch
from pyspark.sql import functions as F


def test_written_tables_do_not_change(spark):
    drawn = spark.range(100).repartition(4).withColumn("draw", F.rand())
    written = scratch.materialize(drawn, "drawn")
    assert sorted(written.collect()) == sorted(written.collect())
    assert written.dtypes == drawn.dtypes


def test_the_setting_for_shuffle_files_is_put_back(spark):
    before = spark.conf.get(scratch._CLEANUP)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert scratch.materialize(sums, "sums", free=True).count() == 7
    assert spark.conf.get(scratch._CLEANUP) == before
    assert sums.count() == 7  # the same plan can be run again

    failing = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        scratch.materialize(failing, "failing", free=True)
    assert spark.conf.get(scratch._CLEANUP) == before


def test_only_scratch_tables_are_erased(spark, tmp_path):
    one, other = (scratch.materialize(spark.range(5), name) for name in ("one", "other"))
    folder = Path(one.inputFiles()[0].removeprefix("file://")).parent
    scratch.erase(one)
    assert not folder.exists() and other.count() == 5
    spark.range(5).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    with pytest.raises(ValueError, match="no scratch table"):
        scratch.erase(other.join(kept, "id"))
    assert kept.count() == 5 and other.count() == 5
