"""Helpers that the operators share: bounded Arrow batches and file systems."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did."""
    root = str(Path(__file__).resolve().parents[2])
    settings = spark.sparkContext.environment
    known = [part for part in settings.get("PYTHONPATH", "").split(os.pathsep) if part]
    if root not in known:
        settings["PYTHONPATH"] = os.pathsep.join([root, *known])


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def key_of(*names: str) -> Column:
    """The columns as one text that is never null, to join and count rows by."""
    parts = (F.coalesce(F.concat(F.lit("="), F.col(f"`{n}`").cast("string")), F.lit("-")) for n in names)
    return F.concat_ws(":", *parts)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def bounded(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `column` has about `limit` bytes at most.

    A single longer value makes a batch of its own; nothing is cut. After the last batch the
    memory that Arrow has free goes back: the worker waits, with it, beside other stages.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first, before = 0, 0
        while first < len(ends):
            stop = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, stop - first)
            before, first = int(ends[stop - 1]), stop
    pa.default_memory_pool().release_unused()


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per length from the values in a row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its length."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


# Names of stores that Hadoop and Arrow call differently.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """The URI by which Arrow knows a folder of Hadoop's."""
    parts = urlsplit(uri)
    if parts.scheme == "file":
        return f"file://{parts.path}"
    return parts._replace(scheme=_ARROW_SCHEMES.get(parts.scheme, parts.scheme)).geturl()


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its scheme: without one it is on the default file system of the
    cluster, where Spark's own readers and writers look for it too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


@lru_cache(maxsize=8)
def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share, given with its scheme."""
    return fs.FileSystem.from_uri(arrow_uri(uri))
