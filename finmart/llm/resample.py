"""Resampling to a target distribution: weights of hashed features, then a quickselect.

A document's features are its words and pairs of neighbouring words, each hashed to one of
10,000 buckets. The gain of a bucket is the log ratio of its share in the target texts
to its share in all documents; a document's weight is the mean gain of its features,
looked up in an array. Weight plus a Gumbel draw of the id is its score: the documents with
the highest scores are a sample without replacement by weight.

The `k` highest are found without sorting the rest. Each document has a composite key
(score falling, id rising, then columns that tell equal ids apart). A round draws some
random pivot keys among those still open, counts for each pivot the keys below it, equal
to it, and so above it, over all rows, and keeps the keys between two neighbouring pivots
in which the k-th key lies. With `_PIVOTS` pivots the open keys shrink about as many-fold each round. The
winners, whose keys do not exceed the k-th, alone are range-sorted and numbered.

- The counts of buckets are sums over all documents, of one row for each bucket and task.
- Keys are written once; what is still open is written again after each round, so a round
  reads only that. The driver gets the pivots and their counts.

Defined results: a null or empty text has no features, weight 0, and is too short to be
drawn. A null id draws as an empty one and ranks after other ids. Of rows with equal id and score the
one with fewer features ranks first, then the one with the smaller weight; beyond that rows are
equal and any may be first. Without documents of enough words nothing is drawn; no rows give no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.llm import terms
from finmart.llm.batches import bounded, text_or_empty
from finmart.llm.order import in_order, numbered
from finmart.sources.scratch import materialize

BUCKETS = 10_000
_PIVOTS = 16

# The composite key, smallest first; `row` tells equal rows apart.
_KEY = ("falling", "nameless", "id", "n_features", "weight", "row")


def buckets(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features that end in them) of each stretch of a text."""
    last: list[int] = []
    for words in terms.words(text):
        if not words:
            continue
        single = list(map(crc32, words))
        before = map(crc32, repeat(b" "), chain(last, single))
        # The digest of a pair goes on where that of its first word and a blank ends.
        pairs = map(crc32, words if last else words[1:], before)
        n = 2 * len(words) - (not last)
        yield len(words), np.fromiter(chain(single, pairs), np.int64, n) % BUCKETS
        last = single[-1:]


def _tally(texts: DataFrame, text_col: str) -> np.ndarray:
    """Number of features in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in bounded(batches, "text"):
            found = [b for text in batch.column(0).cast(pa.binary()).to_pylist() for _, b in buckets(text)]
            if found:
                sums += np.bincount(np.concatenate(found), minlength=BUCKETS)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["bucket", "n"])

    # One row for each bucket reaches the driver.
    rows = (
        texts.select(text_or_empty(text_col).alias("text"))
        .mapInArrow(count, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    sums = np.zeros(BUCKETS, np.int64)
    for row in rows:
        sums[row.bucket] = row.n
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket is worth, in thousandths."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratios = ((t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(seed: int, key: str) -> int:
    """A Gumbel draw of an id, in thousandths."""
    drawn = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _scored(docs: DataFrame, worth: np.ndarray, seed: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight, score, row) of every document, written."""
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("drawn"),
        text_or_empty(text_col).alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            counts = []
            for drawn, text in zip(batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                n_words = n = total = 0
                for words, found in buckets(text):
                    n_words += words
                    n += len(found)
                    total += int(worth[found].sum())
                weight = total // n if n else 0
                counts.append((n_words, n, weight, weight + noise(seed, drawn)))
            columns = np.array(counts, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)],
                ["id", "n_words", "n_features", "weight", "score"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    for name in ("n_words", "n_features", "weight", "score"):
        schema = schema.add(name, T.LongType())
    rows = source.mapInArrow(score, schema).withColumn("row", F.monotonically_increasing_id())
    return materialize(rows, "scores")


def _key() -> Column:
    return F.struct(*_KEY)


def _literal(row, schema: T.StructType) -> Column:
    kinds = {field.name: field.dataType for field in schema}
    return F.struct(*[F.lit(row[name]).cast(kinds[name]).alias(name) for name in _KEY])


def _kth(keys: DataFrame, k: int) -> Column:
    """The k-th smallest key, k from 1 to the number of rows."""
    rows, schema = keys, keys.schema
    seed = 0
    while True:
        seed += 1
        drawn = rows.orderBy(F.xxhash64(F.lit(seed), "row"), "row").limit(_PIVOTS)
        # In the order in which Spark compares keys.
        pivots = [_literal(row, schema) for row in drawn.orderBy(*_KEY).collect()]
        # Three ways for each pivot: the keys below it, equal to it, above it.
        passed = F.size(F.filter(F.array(*pivots), lambda pivot: pivot < _key()))
        equal = F.array_contains(F.array(*pivots), _key())
        counts = {
            (row.place, row.equal): row.n
            for row in rows.groupBy(passed.alias("place"), equal.alias("equal")).agg(F.count("*").alias("n")).collect()
        }
        for place in range(len(pivots) + 1):
            between = counts.get((place, False), 0)
            if k <= between:
                break
            k -= between
            if k <= counts.get((place, True), 0):
                return pivots[place]
            k -= counts.get((place, True), 0)
        if place > 0:
            rows = rows.where(_key() > pivots[place - 1])
        if place < len(pivots):
            rows = rows.where(_key() < pivots[place])
        rows = materialize(rows, "open-keys")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; `rank` is null where it is
    not drawn. Drawn are `percent` of the documents with `least_words` words or more."""
    worth = gains(_tally(docs, text_col), _tally(target, target_text_col))
    scored = _scored(docs, worth, seed, id_col, text_col)
    able = F.col("n_words") >= least_words
    k = percent * scored.where(able).count() // 100
    result = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if not k:
        return scored.select(*result, F.lit(None).cast("long").alias("rank"))

    keyed = scored.withColumns({"falling": -F.col("score"), "nameless": F.col("id").isNull()})
    # Nulls compare like values in a struct, and `nameless` stands before them.
    last = _kth(keyed.where(able).select(*_KEY), k)
    drawn = able & (_key() <= last)
    ranked = numbered(in_order(keyed.where(drawn), _KEY, "drawn"), "rank")
    others = keyed.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*result, "rank").unionByName(others.select(*result, "rank"))
