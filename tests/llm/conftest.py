from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import samples


@pytest.fixture
def docs(spark):
    return samples.tricky(spark)


@pytest.fixture
def none(spark):
    return samples.empty(spark)
