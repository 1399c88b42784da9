"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A bin is filled greedily, the longest document that fits first. Then its smallest document
gives way to two unpacked ones if they fill the gap that it leaves more tightly, as long as
that helps.

A bin depends on the lengths that are left, not on the documents, and there are no more
lengths than tokens in a sequence. So the plan is made from the number of documents of each
length: a bin is repeated as often as its lengths last, which uses one of them up. A plan
has about as many different bins as there are lengths, whatever the input. Each document
then finds its place in the plan by its rank among those of its length; ranks
come from counts for each task, so no length, however common, is gathered anywhere.

Defined results: a null or empty text is the end id alone; a longer document than a
sequence is cut into full sequences, and its first piece holds what is over. Repeated rows
are separate documents. Rows with a null id are packed like others. No rows give no
sequences. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finmart.llm.batches import bounded, lists, ranges, text_or_empty
from finmart.llm.tokens import encode_texts
from finmart.sources.scratch import materialize


_BATCH = 2 << 20  # bytes of text that a worker tokenizes at a time


@dataclass(frozen=True)
class Slot:
    """Documents of one length with ranks from `first` on: `each` to a sequence."""

    length: int
    first: int
    each: int
    sequence: int
    offset: int


def _best_pair(left: np.ndarray, gap: int, above: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum in (above, gap]."""
    lengths = np.flatnonzero(left[: gap + 1])
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return None
    best, found = above, None
    for a in lengths[::-1].tolist():
        if 2 * a <= best:
            break  # no smaller partner makes a larger sum
        partners = lengths[: np.searchsorted(lengths, min(gap - a, a), "right")]
        if len(partners) and partners[-1] == a and left[a] < 2:
            partners = partners[:-1]
        if len(partners) and a + partners[-1] > best:
            best, found = a + int(partners[-1]), (a, int(partners[-1]))
            if best == gap:
                break
    return found


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins as (documents of each length, number of such bins) that use up `counts`."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    bins = []
    while len(lengths := np.flatnonzero(left)):
        taken: dict[int, int] = {}
        gap = capacity
        rest = left.copy()
        for length in lengths[::-1].tolist():
            n = min(gap // length, int(rest[length]))
            if n:
                taken[length] = n
                rest[length] -= n
                gap -= n * length
        while gap:
            smallest = min(taken)
            pair = _best_pair(rest, gap + smallest, smallest)
            if pair is None:
                break
            taken[smallest] -= 1
            if not taken[smallest]:
                del taken[smallest]
            for length in pair:
                taken[length] = taken.get(length, 0) + 1
                rest[length] -= 1
            # The document that gave way goes into later bins.
            rest[smallest] += 1
            gap += smallest - sum(pair)
        times = min(int(left[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            left[length] -= n * times
        bins.append((taken, times))
    return bins


def slots_of(bins: list[tuple[dict[int, int], int]]) -> list[Slot]:
    slots, used, sequence = [], {}, 0
    for taken, times in bins:
        offset = 0
        for length in sorted(taken, reverse=True):
            first = used.get(length, 0)
            slots.append(Slot(length, first, taken[length], sequence, offset))
            used[length] = first + taken[length] * times
            offset += length * taken[length]
        sequence += times
    return slots


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, rank[, ids]): pieces of at most
    `capacity` tokens; `rank` counts the pieces of this length in the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in bounded(batches, "text", _BATCH):
            ids, n_tokens = encode_texts(batch.column(1), tokenizer, end_id)
            pieces = -(-n_tokens // capacity)
            owner = np.repeat(np.arange(len(n_tokens)), pieces)
            piece = ranges(np.zeros(len(pieces), np.int64), pieces)
            over = n_tokens - (pieces - 1) * capacity
            length = np.where(piece == 0, over[owner], capacity)
            ends = np.cumsum(length)
            start = ends - length - (np.cumsum(n_tokens) - n_tokens)[owner]
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), length.tolist())]
            # Rank: position among the equal lengths of the batch, after those before it.
            order = np.argsort(length, kind="stable")
            in_order = length[order]
            firsts = np.flatnonzero(np.append(True, np.diff(in_order) > 0)) if len(order) else order
            sizes = np.diff(np.append(firsts, len(order)))
            rank = np.empty(len(order), np.int64)
            rank[order] = ranges(seen[in_order[firsts]], sizes)
            seen[in_order[firsts]] += sizes
            columns = [
                batch.column(0).take(pa.array(owner)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(np.full(len(owner), task), pa.int64()),
                pa.array(rank),
            ]
            if with_ids:
                columns.append(lists(ids, length, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "piece", "start", "length", "ids_crc32", "task", "rank"]
    names += ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(
        cut,
        f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "task bigint, rank bigint" + ", ids array<int>" * with_ids,
    )


# Counts of a length in a task, at 12 bytes each, that are sent to every executor.
_BROADCAST = 4 << 20


def _slot_table(spark: SparkSession, slots: list[Slot]) -> DataFrame:
    """(length, slots): the slots of each length by their first rank."""
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for slot in sorted(slots, key=lambda slot: (slot.length, slot.first)):
        entry = (slot.first, slot.each, slot.sequence, slot.offset)
        by_length.setdefault(slot.length, []).append(entry)
    entry = "struct<first: bigint, each: bigint, sequence: bigint, offset: bigint>"
    return spark.createDataFrame(list(by_length.items()), f"length bigint, slots array<{entry}>")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset[, ids])."""
    pieces = materialize(
        token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces"
    )
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # At most one row per length reaches the driver.
    counts = by_task.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("tasks")).collect()
    slots = slots_of(plan_bins({row.length: row.n for row in counts}, capacity))

    # Places of a task's documents among all of a length: a row per task, joined without
    # moving the pieces, which have their ids, as long as it is small.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    offsets = (
        by_task.select("task", F.col("length").cast("int").alias("length"), before)
        .groupBy("task")
        .agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("befores"))
    )
    if sum(row.tasks for row in counts) <= _BROADCAST:
        offsets = F.broadcast(offsets)
    place = F.col("rank") + F.element_at("befores", F.col("length").cast("int"))
    plan = _slot_table(docs.sparkSession, slots)
    most = max(Counter(slot.length for slot in slots).values(), default=1)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])

    def later(at: Column, step: Column) -> Column:
        first = F.get("slots", at + step)["first"]
        return F.when(first <= F.col("place"), at + step).otherwise(at)

    placed = (
        pieces.join(offsets, "task")
        .withColumn("place", place)
        .join(F.broadcast(plan), "length")
        # The last slot that does not begin behind the place, by bisection.
        .withColumn("slot", F.get("slots", F.aggregate(steps, F.lit(0), later)))
    )
    place_in_slot = F.col("place") - F.col("slot.first")
    each = F.col("slot.each")
    return placed.select(
        F.col(f"`{id_col}`"),
        *("piece", "start", "length", "ids_crc32"),
        (F.col("slot.sequence") + F.call_function("div", place_in_slot, each)).alias("sequence_id"),
        (F.col("slot.offset") + place_in_slot % each * F.col("length")).alias("offset"),
        *["ids"] * with_ids,
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_pieces) of pieces packed with their ids; a group holds one
    sequence, so at most its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids"),
        F.count("*").alias("n_pieces"),
    )
