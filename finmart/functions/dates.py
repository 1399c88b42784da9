from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def report_month(day: Column) -> Column:
    """A date as 'yyyy-MM'; NULL stays NULL."""
    return F.date_format(day, "yyyy-MM")
