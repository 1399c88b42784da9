"""Versions of the warehouse: the files of each in a folder of its own, and a small table
that says where the tables of a version are.

A version is published by appending its one row there, after all its files are written.
So readers see the version before or the version after, whole, and what a load leaves
that died half way is never looked at. A version may name folders of earlier ones: the
months of the fact that a load did not touch stay where they are. Nothing is deleted; one
load runs at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from finmart.sources.lake import Lake

_ROW = "number bigint, id string, tables map<string,string>, fact array<struct<month:int,folder:string>>"


@dataclass(frozen=True)
class Version:
    """Folders are relative to the warehouse zone."""

    number: int = 0
    id: str = ""
    tables: dict[str, str] = field(default_factory=dict)
    # The month of the fact, as 202604, None for rows without a day.
    fact: dict[int | None, str] = field(default_factory=dict)

    def following(self) -> Version:
        """The next version, which has no tables yet."""
        return Version(self.number + 1, uuid.uuid4().hex)

    def folder(self, table: str) -> str:
        """Where this version writes a table."""
        return f"v{self.number:06d}-{self.id[:8]}/{table}"


def _manifests(lake: Lake) -> str:
    return lake.warehouse("versions")


def current(spark: SparkSession, lake: Lake) -> Version:
    """The published version; one without a number and without tables if there is none."""
    try:
        known = spark.read.schema(_ROW).json(_manifests(lake))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Version()
    row = known.orderBy(F.desc("number"), "id").first()
    if row is None:
        return Version()
    return Version(row.number, row.id, dict(row.tables), {part.month: part.folder for part in row.fact})


def publish(spark: SparkSession, lake: Lake, version: Version) -> None:
    """Make a version whose files are all written the current one."""
    if current(spark, lake).number != version.number - 1:
        raise RuntimeError(f"another load has published version {version.number} meanwhile")
    row = (version.number, version.id, version.tables, list(version.fact.items()))
    spark.createDataFrame([row], _ROW).coalesce(1).write.mode("append").json(_manifests(lake))
