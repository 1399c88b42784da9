"""Reading physical plans."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df: DataFrame) -> str:
    """The plan as adaptive execution left it after running all of it."""
    query = df._jdf.queryExecution()
    query.executedPlan().execute().count()
    plan = query.executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Spark settings for a while; underscores stand for dots."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
