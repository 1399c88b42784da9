"""Quality rules: counts of every text, and a likelihood ratio of hashed n-grams.

The base rules reject short texts and texts that mostly repeat themselves. The verdict on
the others compares two multinomials over hashed n-grams of `_GRAM` bytes: one of trusted
documents, one of the whole corpus. A document's score is the mean log ratio of its
n-grams; it stays if the score reaches a threshold that holds for every document. N-grams
of bytes are few enough to be known from few trusted documents, also in words never seen.

- The corpus counts cover every document; what tasks send on are sums for each bucket, of
  which there are a fixed number.
- The trusted documents are at most `trusted_limit` labelled rows (those with the smallest
  hash of their id), and so are the rejected ones that help to place the threshold.
- Half of the labelled rows, by the hash of their id, make the trusted multinomial. The
  others, unseen by it, place the threshold: where it parts their scores with the least
  weighted errors, wrongly rejecting a trusted document weighing most, in the middle of
  the widest such gap. Log ratios are whole multiples of 2^-20, so sums and verdicts do not depend on
  the order of rows.

Defined results: a null or empty text has no words and fails the base rules; a row with a
null id counts for the corpus and gets a verdict, but is never a labelled one; labels
without an id or a quality are ignored, and of contradicting labels the lowest counts.
Without trusted or without rejected rows in both halves there is no threshold, and the
base rules decide; the score of a text shorter than an n-gram is 0.
Repeated rows each count. `quality_rules` keeps all other columns out; `keep_good`
keeps them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.llm.batches import bounded, ranges, text_or_empty
from finmart.llm.tiles import tile

BUCKETS = 1 << 16
_GRAM = 4  # bytes
_BATCH = 1 << 20  # bytes of text whose arrays a worker holds at once
_GRID = 1 << 20  # log ratios are whole numbers of 1 / _GRID
_BINS = 1 << 10  # bins of the labelled scores for each unit
_WEIGHT = 20  # a trusted document rejected counts as so many others kept

# White space between words, and the signs that are counted.
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SIGN = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANKS = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RESULTS = [*COUNTS, "base_failed", "kept", "score"]


class Words:
    """The words of a batch of texts, as numbers of the distinct ones."""

    def __init__(self, texts: pa.Array):
        tiles = tile(texts, _cuts)
        is_word = np.array([x[0] not in _BLANKS for x in tiles.distinct], bool)
        owner = np.repeat(np.arange(len(texts)), tiles.per_text)
        word = is_word[tiles.which] if len(is_word) else np.zeros(0, bool)
        self.n_texts = len(texts)
        self.distinct = tiles.distinct
        self.number, self.owner = tiles.which[word], owner[word]
        self.n_words = np.bincount(self.owner, minlength=len(texts))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each word."""
        sums = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(self.n_words)
        return sums[ends] - sums[ends - self.n_words]

    def lengths(self) -> np.ndarray:
        distinct = np.fromiter(map(len, self.distinct), np.int64, len(self.distinct))
        return distinct[self.number] if len(distinct) else np.zeros(0, np.int64)

    def in_repeated_windows(self, width: int = 3) -> np.ndarray:
        """Whether each word is in a window of `width` words found again in its text."""
        marked = np.zeros(len(self.number), bool)
        n = len(self.number) - width + 1
        if n < 2:
            return marked
        whole = np.flatnonzero(self.owner[:n] == self.owner[width - 1 :])
        # Number the windows step by step, so that no two share a number.
        key = self.owner[whole].astype(np.int64)
        for k in range(width):
            key = key * len(self.distinct) + self.number[whole + k]
            key = np.unique(key, return_inverse=True)[1]
        again = whole[np.bincount(key)[key] > 1] if len(key) else whole
        for k in range(width):
            marked[again + k] = True
        return marked


class Grams:
    """The bucket of every n-gram of a batch of texts; none crosses two texts."""

    def __init__(self, texts: pa.Array):
        raw = [text.encode() for text in texts.to_pylist()]
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.n = np.maximum(sizes - _GRAM + 1, 0)
        hashed = np.zeros(max(len(data) - _GRAM + 1, 0), np.uint64)
        for k in range(_GRAM):
            hashed = hashed << np.uint64(8) | data[k : k + len(hashed)]
        # The upper bits of a product with an odd number.
        bucket = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        starts = np.cumsum(sizes) - sizes
        self.bucket = bucket[ranges(starts, self.n)].astype(np.int64)

    def per_text(self, ratios: np.ndarray) -> np.ndarray:
        """Sum of the log ratios of each text."""
        sums = np.concatenate([[0], np.cumsum(ratios[self.bucket])])
        ends = np.cumsum(self.n)
        return sums[ends] - sums[ends - self.n]

    def tally(self, chosen: np.ndarray) -> np.ndarray:
        """Number of n-grams of the chosen texts in each bucket."""
        return np.bincount(self.bucket[np.repeat(chosen, self.n)], minlength=BUCKETS)


def _cuts(data: np.ndarray) -> np.ndarray:
    blank = _BLANK[data]
    marked = np.zeros(len(data), bool)
    marked[1:] = blank[1:] != blank[:-1]
    return marked


def _count_signs(text: str) -> int:
    return int(_SIGN[np.frombuffer(text.encode(), np.uint8)].sum())


def _count_repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def count(texts: pa.Array, words: Words) -> dict[str, np.ndarray]:
    values = texts.to_pylist()
    return {
        "n_words": words.n_words,
        "word_chars": words.per_text(words.lengths()),
        "n_symbols": np.array([_count_signs(x) for x in values], np.int64),
        "n_dup_lines": np.array([_count_repeated_lines(x) for x in values], np.int64),
        "n_repeat_words": words.per_text(words.in_repeated_windows().astype(np.int64)),
    }


def _labelled(labels: DataFrame, id_col: str, quality_col: str, limit: int):
    """Of the trusted and of the rejected rows, `limit` of each at most: the sorted ids of
    either half."""
    rated = (
        labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isin(0, 1))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min(quality_col).alias("quality"))
        .withColumn("hash", F.xxhash64("id"))
    )
    for quality in (1, 0):
        found = rated.where(F.col("quality") == quality).orderBy("hash", "id").limit(limit)
        rows = [(row.id, row.hash % 2) for row in found.collect()]
        yield [np.array(sorted(i for i, half in rows if half == k), np.int64) for k in (0, 1)]


def _is_in(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(ids), bool)
    return known[np.minimum(np.searchsorted(known, ids), len(known) - 1)] == ids


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """Document ids, with a number that no label has for null."""
    return batch.column(0).fill_null(-(2**63)).to_numpy()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    trusted_limit: int = 20_000,
) -> tuple[np.ndarray, int | None]:
    """Log ratio of each bucket, and the threshold in the same unit."""
    trusted, rejected = _labelled(labels, id_col, quality_col, trusted_limit)
    shown, trusted = trusted[0], trusted[1]
    rejected = np.sort(np.concatenate(rejected))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in bounded(batches, "text", _BATCH):
            grams = Grams(batch.column(1))
            counts[0] += np.bincount(grams.bucket, minlength=BUCKETS)
            counts[1] += grams.tally(_is_in(_keys(batch), shown))
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])],
            ["bucket", "raw", "good"],
        )

    # One row per bucket reaches the driver.
    sums = (
        source.mapInArrow(tally, "bucket bigint, raw bigint, good bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .collect()
    )
    table = np.zeros((2, BUCKETS))
    for row in sums:
        table[:, row.bucket] = row.raw, row.good
    shares = (table + 1) / (table.sum(axis=1, keepdims=True) + BUCKETS)
    ratios = np.rint((np.log(shares[1]) - np.log(shares[0])) * _GRID).astype(np.int64)
    if not (len(shown) and len(trusted) and len(rejected)):
        return ratios, None

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", _BATCH):
            keys = _keys(batch)
            good, bad = _is_in(keys, trusted), _is_in(keys, rejected)
            batch = batch.filter(pa.array(good | bad))
            words, grams = Words(batch.column(1)), Grams(batch.column(1))
            repeated = words.per_text(words.in_repeated_windows().astype(np.int64))
            passed = ~_base_failed(words.n_words, repeated)
            bins = grams.per_text(ratios)[passed] * _BINS // (_GRID * grams.n[passed])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins), pa.array(good[good | bad][passed])], ["bin", "good"]
            )

    known = np.sort(np.concatenate([trusted, rejected]))
    bins = (
        _only(source, known)
        .mapInArrow(rate, "bin bigint, good boolean")
        .groupBy("bin", "good")
        .count()
        .collect()
    )
    return ratios, _threshold({(row.bin, row.good): row["count"] for row in bins})


def _only(source: DataFrame, known: np.ndarray) -> DataFrame:
    """Rows with a labelled id: at most twice the limit of labelled rows are broadcast."""
    ids = source.sparkSession.createDataFrame(pa.table({"id": known}))
    return source.join(F.broadcast(ids), "id", "left_semi")


def _threshold(counts: dict[tuple[int, bool], int]) -> int | None:
    """Middle of the widest gap between bins where a cut has the least weighted errors."""
    if not counts:
        return None
    places = sorted({place for place, _ in counts})
    lost, kept = 0, sum(n for (_, good), n in counts.items() if not good)
    best, gap = None, None
    for low, high in zip([None, *places], places):
        # Cut below `high`: what is in `low` and under is rejected.
        if low is not None:
            lost += counts.get((low, True), 0)
            kept -= counts.get((low, False), 0)
        wide = 0 if low is None else high - low
        rank = (_WEIGHT * lost + kept, -wide)
        if best is None or rank < best:
            best, gap = rank, (high if low is None else low + 1, high)
    return (gap[0] + gap[1]) * (_GRID // _BINS) // 2


def _base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """The columns of `docs` as c0, c1, ..., and the counts and verdicts of each row."""
    place = {name: k for k, name in enumerate(docs.columns)}
    id_at, text_at = place[id_col], place[text_col]
    ratios, threshold = fit(docs, labels, id_col=id_col, text_col=text_col, **options)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, f"c{text_at}", _BATCH):
            texts = batch.column(text_at).fill_null("")
            words = Words(texts)
            counts = count(texts, words)
            failed = _base_failed(counts["n_words"], counts["n_repeat_words"])
            grams = Grams(texts)
            sums = grams.per_text(ratios)
            kept = ~failed
            if threshold is not None:
                kept &= sums >= threshold * grams.n
            score = sums / np.maximum(grams.n, 1) / _GRID
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *(pa.array(counts[name]) for name in COUNTS),
                    *map(pa.array, (failed, kept, score)),
                ],
                [*(f"c{k}" for k in range(len(place))), *_RESULTS],
            )

    fields = docs.schema.fields
    schema = T.StructType([T.StructField(f"c{k}", field.dataType) for k, field in enumerate(fields)])
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean").add("score", "double")
    return docs.toDF(*(f"c{k}" for k in range(len(fields)))).mapInArrow(judge, schema)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    trusted_limit: int = 20_000,
) -> DataFrame:
    """(id, counts, base_failed, kept, score) of every document; `score` is the mean log
    ratio of its n-grams."""
    columns = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    judged = _judged(
        columns, labels, id_col, text_col, quality_col=quality_col, trusted_limit=trusted_limit
    )
    return judged.select(F.col("c0").alias(id_col), *_RESULTS)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    trusted_limit: int = 20_000,
) -> DataFrame:
    """The rows of `docs` that are kept, with their columns."""
    judged = _judged(
        docs, labels, id_col, text_col, quality_col=quality_col, trusted_limit=trusted_limit
    )
    names = (F.col(f"c{k}").alias(name) for k, name in enumerate(docs.columns))
    return judged.where("kept").select(*names)
