"""Ranked lexical search by presence masks: the best documents of each item.

Documents are read in blocks. In a block every term has a bitmap of the documents that hold
it. The bitmaps of an item's terms, turned by bits, give each document a mask of the terms
it matches; documents of one mask make a group, whose scores cannot exceed the sum of the
most that each term of the mask gives to any document of the block. Groups are evaluated
from the highest such bound down, exactly, until the bound is below the worst of the best
`k` scores found so far: equal bounds are still evaluated, as a smaller id wins a tie. A
task carries the best scores from block to block; what it sends on are at most `k` rows
for each item, ranked within lanes of tasks first, then over all.

- The texts are read twice: once to count (documents, terms), once to list for
  each document which terms of the items it holds, and how often. The list is written, and
  both the counts of the terms and the ranking start from it.
- Items are worked on in blocks of about `ITEMS` items, dealt by the hash of their id and text: a
  set of any size never is in one place, and a larger set takes more passes.
- A block of documents has bitmaps of `_CELLS` bits at most, so memory does not grow with
  the number of terms; lists of words are made for a stretch of a long text at a time.

Scores are 64-bit integers: see `_impacts`. Weights are computed in doubles, once.

Defined results: a null text has no terms, and a document without terms does not count.
Equal rows of documents each count; where only null ids or equal ids tie, all are equal. Null ids
are the largest. Rows of items with equal id and text are one item; an item with a null
id is an item. An item without a match has no row, and no rows of either table give none.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm import terms
from finmart.llm.batches import bounded, key_of, lists, ranges, text_or_empty
from finmart.sources.scratch import materialize

ITEMS = 1024  # items of a block, as a mean
_CELLS = 1 << 25  # bits of the bitmaps of a block of documents
_DOCS = 1 << 14  # documents of a block at most
_LANES = 256  # groups of tasks whose rows are ranked among themselves first
_NAMELESS = 2**63 - 1  # stands for a null id while rows are ordered


@dataclass
class Block:
    """Some items: their ids, and their terms as numbers with repeats."""

    ids: list
    terms: list[np.ndarray]  # numbers of the distinct terms of each item
    times: list[np.ndarray]  # how often each occurs in the item
    numbers: dict[bytes, int]


def _read_items(rows) -> Block:
    block = Block([], [], [], {})
    for row in rows:
        found = Counter(word for some in terms.words(row.text.encode()) for word in some)
        if found:
            block.ids.append(row.id)
            numbers = [block.numbers.setdefault(word, len(block.numbers)) for word in found]
            block.terms.append(np.array(numbers, np.int64))
            block.times.append(np.array(list(found.values()), np.int64))
    return block


def _postings(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: the numbers of the known terms it
    holds, and their counts there."""
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            sizes, held, tfs, counts = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                n, found = 0, Counter()
                for some in terms.words(text):
                    n += len(some)
                    found.update(map(numbers.get, some))
                found.pop(None, None)
                sizes.append(n)
                counts.append(len(found))
                held.extend(found)
                tfs.extend(found.values())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    lists(np.array(held, np.int32), np.array(counts, np.int64), pa.int32()),
                    lists(np.array(tfs, np.int64), np.array(counts, np.int64), pa.int64()),
                ],
                ["id", "n", "terms", "tfs"],
            )

    listed = source.mapInArrow(read, "id bigint, n bigint, terms array<int>, tfs array<bigint>")
    return materialize(listed.where("n > 0"), "postings")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one unit of weight is worth: grows with the count of the term, falls with the
    length of the document against the mean."""
    m = 100 - 25 + 25 * n * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Documents:
    """A block of documents, with bitmaps of the terms they hold."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, held: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.ids, self.counts, self.held, self.impacts = ids, counts, held, impacts
        self.starts = np.cumsum(counts) - counts
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, held, impacts)
        inside = np.zeros((n_terms, len(ids)), bool)
        inside[held, np.repeat(np.arange(len(ids)), counts)] = True
        self.bitmaps = np.packbits(inside, axis=1)

    def groups(self, wanted: np.ndarray, values: np.ndarray):
        """Documents with any of the wanted terms by their mask, from the highest bound
        down: (documents, bounds of the groups, ends of the groups)."""
        rows = self.bitmaps[wanted]
        any_of = np.unpackbits(np.bitwise_or.reduce(rows), count=len(self.ids))
        docs = np.flatnonzero(any_of)
        if not len(docs):
            return docs, docs, docs
        # Turned by bits: the bytes of a document's mask lie in one row.
        turned = np.packbits(np.unpackbits(rows, axis=1, count=len(self.ids))[:, docs], axis=0)
        by_mask = np.lexsort(turned) if len(turned) > 8 else np.argsort(_as_number(turned), kind="stable")
        turned = turned[:, by_mask]
        new = np.ones(len(docs), bool)
        new[1:] = (turned[:, 1:] != turned[:, :-1]).any(axis=0)
        firsts = np.flatnonzero(new)
        masks = np.unpackbits(turned[:, firsts], axis=0, count=len(wanted))
        bounds = (values * self.most[wanted]) @ masks.astype(np.int64)
        lengths = np.diff(np.append(firsts, len(docs)))
        best = np.argsort(-bounds, kind="stable")
        return docs[by_mask][ranges(firsts[best], lengths[best])], bounds[best], np.cumsum(lengths[best])

    def scores(self, docs: np.ndarray, value_of: np.ndarray) -> np.ndarray:
        """Exact scores, given the value of each term (nothing where it is not wanted)."""
        counts = self.counts[docs]
        places = ranges(self.starts[docs], counts)
        parts = value_of[self.held[places]] * self.impacts[places]
        sums = np.concatenate([[0], np.cumsum(parts)])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]


def _as_number(turned: np.ndarray) -> np.ndarray:
    padded = np.zeros((8, turned.shape[1]), np.uint8)
    padded[: len(turned)] = turned
    return np.ascontiguousarray(padded.T).view(np.uint64).ravel()


class Best:
    """The `k` best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a score has to reach to matter; nothing below 1 does."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
        best = np.lexsort([ids, -scores])
        best = best[scores[best] > 0][: self.k]
        self.ids, self.scores = ids[best], scores[best]

    def search(self, block: Documents, wanted: np.ndarray, values: np.ndarray, value_of: np.ndarray) -> None:
        """Evaluate groups until no bound reaches the worst of the best."""
        docs, bounds, ends = block.groups(wanted, values)
        done, step = 0, 4 * self.k
        while done < len(bounds) and bounds[done] >= self.least:
            # Whole groups, about `step` documents, and none that is out of reach.
            start = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, start + step, "right")))
            stop = min(stop, int(np.searchsorted(-bounds, -self.least, "right")))
            some = docs[start : ends[stop - 1]]
            self.add(block.ids[some], block.scores(some, value_of))
            done, step = stop, 2 * step


def _blocks(batches: Iterator[pa.RecordBatch], n_terms: int, n_docs: int, all_terms: int) -> Iterator[Documents]:
    """The written postings in blocks of documents; a document without a known term has
    nothing to add."""
    size = max(1, min(_DOCS, _CELLS // max(n_terms, 1)))
    held: list[pa.RecordBatch] = []
    n = 0

    def block() -> Documents:
        table = pa.Table.from_batches(held).combine_chunks()
        listed = table.column("terms").combine_chunks()
        counts = np.diff(listed.offsets.to_numpy()).astype(np.int64)
        tf = table.column("tfs").combine_chunks().flatten().to_numpy()
        lengths = np.repeat(table.column("n").to_numpy(), counts)
        return Documents(
            table.column("id").combine_chunks().fill_null(_NAMELESS).to_numpy(),
            counts,
            listed.flatten().to_numpy().astype(np.int64),
            _impacts(tf, lengths, n_docs, all_terms),
            n_terms,
        )

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            if n and n + piece.num_rows > size:
                yield block()
                held, n = [], 0
            held.append(piece)
            n += piece.num_rows
    if n:
        yield block()


def _search(docs: DataFrame, block: Block, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score, lane): the best of each task."""
    postings = _postings(docs, id_col, text_col, block.numbers)
    counts = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    # One row for each term of the block of items.
    df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    n_terms = len(block.numbers)
    weights = np.array([weight(counts.docs, df.get(t, 0)) for t in range(n_terms)], np.int64)
    all_docs, all_terms = counts.docs, counts.terms

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in block.ids]
        value_of = np.zeros(n_terms, np.int64)
        for some in _blocks(batches, n_terms, all_docs, all_terms):
            for item, (wanted, times) in enumerate(zip(block.terms, block.times)):
                values = weights[wanted] * times
                value_of[wanted] = values
                best[item].search(some, wanted, values, value_of)
                value_of[wanted] = 0
        found = np.array([len(b.ids) for b in best], np.int64)
        ids = np.concatenate([b.ids for b in best]) if best else np.zeros(0, np.int64)
        scores = np.concatenate([b.scores for b in best]) if best else ids
        lane = TaskContext.get().partitionId() % _LANES
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best), dtype=np.int64), found)),
                pa.array(ids, mask=ids == _NAMELESS),
                pa.array(scores),
                pa.array(np.full(len(ids), lane, np.int32)),
            ],
            ["item", "id", "score", "lane"],
        )

    return postings.mapInArrow(rank, "item bigint, id bigint, score bigint, lane int")


def _ranked(rows: DataFrame, k: int, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    item_col: str = "item_id",
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_text_col: str = "text",
) -> DataFrame:
    """(item, rank, document, score): the `k` best documents of every item, scores above 0."""
    spark = docs.sparkSession
    asked = items.select(
        F.col(f"`{item_col}`").alias("id"), text_or_empty(item_text_col).alias("text")
    ).distinct()
    n_blocks = max(1, -(-asked.count() // ITEMS))
    dealt = F.pmod(F.xxhash64(key_of("id"), "text"), F.lit(n_blocks))
    asked = materialize(asked.withColumn("block", dealt), "items")
    id_type = items.schema[item_col].dataType
    parts = []
    for number in range(n_blocks):
        # About ITEMS rows.
        block = _read_items(asked.where(F.col("block") == number).collect())
        if not block.ids:
            continue
        found = _search(docs, block, k, doc_col, text_col)
        best = _ranked(_ranked(found, k, "item", "lane").drop("rank"), k, "item")
        names = spark.createDataFrame(
            list(enumerate(block.ids)), f"item bigint, item_id {id_type.simpleString()}"
        )
        parts.append(materialize(best.join(F.broadcast(names), "item"), "found"))
    if not parts:
        return docs.limit(0).select(
            F.lit(None).cast(id_type).alias(item_col),
            F.lit(0).alias("rank"),
            F.lit(None).cast("long").alias(doc_col),
            F.lit(None).cast("long").alias("score"),
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(doc_col), "score"
    )
