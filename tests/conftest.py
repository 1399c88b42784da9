from __future__ import annotations

import sys
from collections.abc import Iterator
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import TESTDATA
from finmart.sources.session import get_spark_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> Iterator[SparkSession]:
    session = get_spark_session(
        "finmart-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
        master="local[4]",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    path = TESTDATA / "sf0.001"
    if not path.is_dir():
        pytest.skip(f"no test tables in {path}")
    return str(path)
