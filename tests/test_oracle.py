"""Every registered query against DuckDB."""

from __future__ import annotations

import pytest

from compare import duck, duck_bag, spark_bag
from finmart.plans.oracle import ORACLE_SQL
from finmart.plans.registry import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    with duck(sf_dir) as connection:
        result = connection.execute(ORACLE_SQL[name])
        assert sorted(ours.columns) == sorted(column[0] for column in result.description)
        expected = duck_bag(connection, ORACLE_SQL[name])
    actual = spark_bag(ours)
    assert actual == expected
    assert actual
