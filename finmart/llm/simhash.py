"""SimHash near-duplicates with a bit-sliced comparison.

Each text gets a 64-bit fingerprint of its word shingles. Fingerprints within the radius
differ in `radius` bits at most, so if the bits are cut into `radius` + 3 blocks, three
blocks agree. Equal fingerprints are one candidate; candidates are dealt by each choice of
three blocks, sorted, and compared with the d-th after them for d = 1, 2, ... as long
as they agree in those blocks. Comparison is bit-sliced: bit planes are stored
vertically, a carry-save counter adds the differing planes of 64 pairs a word at once, and
blocks of which all pairs exceed the radius are left.

Links are not listed: a bucket sends on one edge for each fingerprint that is not
the first of its component in the bucket. Components over all buckets come from repeated
minima, cut by written tables. A bucket with more fingerprints than `_BUCKET` is dealt again by the
remaining bits; a bucket of that second deal is one group, however many of the fingerprints that its
remaining 21 bits or so tell apart it has.

Defined results: null and empty texts, and texts without a word, have fingerprint zero
and link like others; a text of fewer words than a shingle is one shingle. Null ids take
part, and a component of null ids only has a null id. Repeated rows are repeated in the
result. No rows give no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.batches import bounded, fresh, key_of, text_or_empty
from finmart.sources.scratch import materialize

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SEED = 42
_BUCKET = 4_000  # fingerprints that a task compares with each other
_CHOSEN = 3


def fingerprint(text: str, shingle: int) -> int:
    words = _WORD.findall(text.encode().lower())  # bytes: lowers A-Z only
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], _SEED) for a, b in zip(starts, ends)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    often = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(often, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint as a signed long) of every whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            values = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(work, f"id {kind}, fp bigint")


def _masks(bits: list[int], n_blocks: int) -> list[list[int]]:
    """Bits of each choice of blocks, of about equal size."""
    blocks = [part.tolist() for part in np.array_split(np.array(bits), n_blocks)]
    return [sum(chosen, []) for chosen in combinations(blocks, _CHOSEN)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << bit for bit in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(candidates: DataFrame, masks: list[list[int]], *outer: str) -> DataFrame:
    """Each fingerprint once for each mask, with its bits there; only those that share
    them with another one. The number of fingerprints that do is `n`."""
    chosen = F.array(
        *(
            F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(bits))).alias("key"))
            for k, bits in enumerate(masks)
        )
    )
    rows = candidates.select(*outer, "fp", F.explode(chosen).alias("at")).select(
        *outer, F.col("at.mask").alias("mask"), F.col("at.key").alias("key"), "fp"
    )
    # Counted on the map side and written, so that no task gets a hot bucket to count it.
    bucket = [*outer, "mask", "key"]
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(materialize(counts, "buckets"), bucket)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save addition: sum bits and carry bits of three bit vectors."""
    ab = a ^ b
    return ab ^ c, (a & b) | (ab & c)


class Planes:
    """The bits of many fingerprints, stored by bit instead of by fingerprint."""

    def __init__(self, values: np.ndarray):
        words = -(-len(values) // 64) + 1  # one more, for the shift
        self.planes = np.zeros((64, words), np.uint64)
        for bit in range(64):
            ones = (values >> np.uint64(bit)) & np.uint64(1)
            packed = np.packbits(ones.astype(np.uint8), bitorder="little")
            self.planes[bit].view(np.uint8)[: len(packed)] = packed

    def close(self, d: int, valid: np.ndarray, radius: int) -> np.ndarray:
        """The places i, out of the marked ones, whose value and the d-th after it differ in
        at most `radius` bits, up to 7."""
        packed = np.packbits(valid, bitorder="little")
        alive = np.zeros(self.planes.shape[1], np.uint64)
        alive.view(np.uint8)[: len(packed)] = packed
        at = np.flatnonzero(alive)
        alive = alive[at]
        skip, shift = divmod(d, 64)
        shift, back = np.uint64(shift), np.uint64(64 - shift)
        last = self.planes.shape[1] - 1
        counter = [np.zeros(len(at), np.uint64) for _ in range(4)]  # ones, twos, fours, over
        for first in range(0, 64, 8):
            x = []
            for plane in self.planes[first : first + 8]:
                later = plane[np.minimum(at + skip, last)]
                if shift:
                    later = (later >> shift) | (plane[np.minimum(at + skip + 1, last)] << back)
                x.append(plane[at] ^ later)
            ones, twos, fours, over = counter
            ones, a = _add(ones, x[0], x[1])
            ones, b = _add(ones, x[2], x[3])
            twos, c = _add(twos, a, b)
            ones, a = _add(ones, x[4], x[5])
            ones, b = _add(ones, x[6], x[7])
            twos, d2 = _add(twos, a, b)
            fours, more = _add(fours, c, d2)
            counter = [ones, twos, fours, over | more]
            alive = alive & ~self._exceeds(counter, radius)
            going = np.flatnonzero(alive)
            if len(going) < len(at):  # blocks of which all pairs are too far are left
                at, alive = at[going], alive[going]
                counter = [part[going] for part in counter]
            if not len(at):
                return at
        bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, column = np.nonzero(bits)
        return at[row] * 64 + column

    @staticmethod
    def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
        """Where the counter is over the radius: compared from the highest bit down."""
        *digits, over = counter
        equal = ~np.zeros_like(over)
        for k in (2, 1, 0):
            if radius >> k & 1:
                equal = equal & digits[k]
            else:
                over = over | (equal & digits[k])
                equal = equal & ~digits[k]
        return over


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest members of the components when a and b are linked as well."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def linked(bucket: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """For each of the values, sorted by bucket, the first place of its component among
    links within its bucket."""
    n = len(values)
    label = np.arange(n)
    planes = Planes(values)
    ends = np.searchsorted(bucket, bucket, "right")
    room = ends - np.arange(n)  # values from here to the end of the bucket
    for d in range(1, int(room.max(initial=1))):
        found = planes.close(d, room > d, radius)
        if len(found):
            label = _join(label, found, found + d)
    return label


def _edges(dealt: DataFrame, radius: int, *outer: str) -> DataFrame:
    """(a, b): fingerprints linked in a bucket, each to the first of its component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in _whole_buckets(batches):
            first = linked(keys, values, radius)
            moved = np.flatnonzero(first != np.arange(len(first)))
            signed = values.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[moved]), pa.array(signed[first[moved]])], ["a", "b"]
            )

    keys = [*outer, "mask", "key"]
    return (
        dealt.select(*keys, "fp")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "fp")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _whole_buckets(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the bucket and value, in pieces that end where a bucket ends."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        rows = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), np.int64) for c in batch.columns])
        held.append(rows)
        size += rows.shape[1]
        if size >= 50_000:
            rows = np.concatenate(held, axis=1)
            changes = np.flatnonzero((rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0))  # fp is last
            if len(changes):
                cut = changes[-1] + 1
                yield _numbered(rows[:, :cut])
                rows = rows[:, cut:]
            held, size = [rows], rows.shape[1]
    if size:
        yield _numbered(np.concatenate(held, axis=1))


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.append(True, (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0))
    return np.cumsum(new), np.ascontiguousarray(rows[-1]).view(np.uint64)


def _components(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex that is not the smallest of its component, and that one."""
    edges = materialize(edges.distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        # Written, as are the roots: the edges of a hot vertex meet it in several tasks.
        least = materialize(least.select("a", F.least("a", "least").alias("least")), "least")
        # Each vertex links its larger neighbours to its smallest one, then to itself.
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        ).distinct()
        large = materialize(large, "large")
        root = materialize(large.groupBy("a").agg(F.min("b").alias("root")), "roots")
        small = large.join(root, "a")
        linked_to = small.select(F.col("b").alias("a"), F.col("root").alias("b")).union(
            root.select("a", F.col("root").alias("b"))
        )
        after = materialize(linked_to.where("a <> b").distinct(), "small")
        if _is_star(after):
            return after
        edges = after


def _is_star(edges: DataFrame) -> bool:
    """Whether every vertex has one edge, to a vertex without one."""
    several = edges.groupBy("a").count().where("count > 1").select("a")
    inner = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a")
    return several.union(inner).isEmpty()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fingerprint, component_id): 16 hex digits, and the smallest id of all rows that
    a chain of links of at most `radius` bits (up to 7) leads to."""
    if not 0 <= radius <= 7:
        raise ValueError("the counter holds radii from 0 to 7")
    marked = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    candidates = materialize(
        marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints"
    )
    n_blocks = radius + _CHOSEN
    masks = _masks(list(range(64)), n_blocks)
    dealt = materialize(_dealt(candidates.select("fp"), masks), "dealt")
    edges = _edges(dealt.where(F.col("n") <= _BUCKET), radius)
    large = dealt.where(F.col("n") > _BUCKET)
    if not large.isEmpty():
        edges = edges.union(_dealt_again(large, masks, n_blocks, radius))
    roots = _components(edges)

    root = F.coalesce("b", "fp")
    members = candidates.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select(
        "fp", "first", root.alias("root")
    )
    least = members.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    least = materialize(least.where("n > 1").select("root", "component_id"), "components")
    alone = F.col("matched").isNull()
    named = members.join(least.withColumn("matched", F.lit(True)), "root", "left").select(
        "fp", F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id")
    )
    return marked.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _dealt_again(
    large: DataFrame, masks: list[list[int]], n_blocks: int, radius: int
) -> DataFrame:
    """Edges of the buckets that are too large for a task, by the bits that they do not
    share: what they agree in then leaves room for few fingerprints."""
    found = None
    # At most as many rows as there are masks.
    for k in sorted(row.mask for row in large.select("mask").distinct().collect()):
        bits = masks[k]
        rest = [bit for bit in range(64) if bit not in bits]
        again = _dealt(
            large.where(F.col("mask") == k).select(F.col("key").alias("outer"), "fp"),
            _masks(rest, n_blocks),
            "outer",
        )
        edges = _edges(again, radius, "outer")
        found = edges if found is None else found.union(edges)
    return found


def one_of_each(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that stay, with their columns: of each component exactly one, with
    its smallest id; of several texts with that id, or of ids that are all null, the one with
    the smallest digest. Rows are known by id and text, so unrelated texts of one id stay."""
    sha = F.sha2(text_or_empty(text_col), 256)
    known = F.struct(F.col(f"`{id_col}`").isNull().alias("absent"), F.col(f"`{id_col}`").alias("id"), sha.alias("sha"))
    named = docs.select(known.alias("known"), F.col(f"`{text_col}`").alias("text"))
    name = fresh(docs, "near_key")
    stays = (
        near_duplicates(named, shingle, radius, "known", "text")
        .where("known = component_id")
        .select("known.id", "known.sha")
        .select(F.concat_ws("/", key_of("id"), "sha").alias(name))
    )
    key = F.concat_ws("/", key_of(id_col), sha)
    found = docs.withColumn(name, key).join(stays, name, "left_semi")
    return found.dropDuplicates([name]).select(*(f"`{column}`" for column in docs.columns))
