"""Intermediate tables in the shared folder named by spark.checkpoint.dir.

A written table cuts the lineage for good: whoever reads it gets the same rows
however often a task is retried or an executor is lost.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="finmart-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no one has used before."""
    return f"{scratch_root(spark)}/finmart/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """Write `df` once and return the written table.

    With `free` the files of the shuffles that led to it go when it is there: nobody reads them
    again, and until the driver collects its garbage they would fill the disks of the executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    if free:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(_CLEANUP)
        elif free:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def erase(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more; everything made from them has to be
    written itself. Other files than those of `materialize` are refused."""
    for table in tables:
        spark = table.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(f"{scratch_root(spark)}/finmart")
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        root = system.makeQualified(root)
        folders = {file.rpartition("/")[0] for file in table.inputFiles()}
        paths = [system.makeQualified(hadoop(folder)) for folder in folders]
        if not all(root.equals(path.getParent()) for path in paths):
            raise ValueError(f"no scratch table: {sorted(folders)}")
        for path in paths:
            system.delete(path, True)
