"""Removal of repeated passages with a sparse suffix array.

Every byte goes that is covered by a string of `length` bytes which also starts anywhere
else, in another document or in the same one. Overlaps count, matches do not cross documents, and
strings are judged on the input.

Sorting every suffix would move each byte hundreds of times. But equal strings contain
equal anchors: the leftmost smallest hash of `_GRAM` bytes inside a string depends on the string
alone. So only suffixes whose anchor occurs twice are sorted, and those that share an
anchor come to the same task as one stretch of text, a run. There they are sorted by
deep-shallow sorting (`suffixes.py`): first the runs, so that runs that are equal as a whole stand for
one, then the suffixes of the different runs of an anchor, by `length` bytes. Suffixes that are
equal so far repeat. Hashes only choose what is sorted; they do not decide.

Equal documents stand for one, as do equal runs of a batch, before anything is moved, so a hot text
is moved a few times at most. Where a common passage begins and ends, runs hold different
surroundings and are not equal. Runs of an anchor with more than `_HOT` of them are therefore cut
into their strings, which are dealt by a hash of the whole string: equal ones still meet, the
others spread, and a task sends each string twice at most while it remembers it.

Defined results: a null text is an empty one; texts shorter than `length` keep all their
bytes. Repeated rows, also of the same id, repeat each other. No rows give no rows. What
is kept is binary, as a character may lose some of its bytes. Columns other than the id
and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.batches import bounded, key_of, ranges, text_or_empty
from finmart.llm.suffixes import sort_strings
from finmart.sources.scratch import materialize

_GRAM = 32  # bytes of an anchor
_SEGMENT = 1 << 23  # string starts that are looked at together
_BLOCK = 8 << 20  # bytes of runs that are sorted together
_HOT = 20_000  # runs of an anchor that are dealt together; of more, each string by itself
_SENT = 50_000  # strings of hot anchors that a task remembers to have sent
_FLUSH = 200_000  # rows that go out together


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the `_GRAM` bytes from each place on."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word[:-step] |= word[step:] << np.uint64(8 * step)
    n = len(data) - _GRAM + 1
    hashed = np.zeros(n, np.uint64)
    for k in range(0, _GRAM, 8):
        hashed = (hashed ^ word[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(32)
    return hashed * np.uint64(0xD6E8FEB86659FD93)


_PLACE = np.uint64(24)  # bits of a place in a segment; the others hold the hash


def _anchors(data: np.ndarray, length: int) -> np.ndarray:
    """Place of the anchor of the string that starts at each place, for all of them that
    fit; the leftmost of equal hashes."""
    hashed = _grams(data) >> _PLACE << _PLACE
    least = hashed | np.arange(len(hashed), dtype=np.uint64)
    width, span = length - _GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return (least & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)


class Runs:
    """Runs of string starts with the same anchor, over the texts of a batch."""

    def __init__(self, texts: list[bytes], length: int):
        self.raw = b"".join(texts)
        data = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        # Starts of strings that do not cross the end of their text.
        per_text = np.maximum(sizes - length + 1, 0)
        parts = [
            self._of(data, first, min(first + _SEGMENT, len(data) - length + 1), length)
            for first in range(0, max(len(data) - length + 1, 0), _SEGMENT)
        ]
        anchor = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        starts = ranges(ends - sizes, per_text)
        owner = np.repeat(np.arange(len(texts)), per_text)
        anchor = anchor[starts]
        new = np.append(True, (np.diff(anchor) != 0) | (np.diff(owner) != 0))[: len(starts)]
        firsts = np.flatnonzero(new)
        self.base = ends - sizes
        self.owner = owner[firsts]
        self.first = starts[firsts]
        self.n = np.diff(np.append(firsts, len(starts)))
        self.anchor = anchor[firsts]
        self.data = data

    @staticmethod
    def _of(data: np.ndarray, first: int, stop: int, length: int) -> np.ndarray:
        return _anchors(data[first : stop + length - 1], length) + first

    def hashes(self) -> np.ndarray:
        """Hash of each run's anchor."""
        if not len(self.anchor):
            return np.zeros(0, np.int64)
        at = self.anchor[:, None] + np.arange(_GRAM)
        window = self.data[at.ravel()]
        return _grams(window)[::_GRAM].view(np.int64)


# A document is known by hashes of its id and its text, which any job finds again; rows
# that are equal in both share all results.
_DOC = ["by_id", "by_text"]
_LEAD, _N = 1 << 10, 1 << 10  # a run as one number: place, bytes before the anchor, strings


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(hash, document, run): a row for each run."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", 2 << 20):
            runs = Runs([x.encode() for x in batch.column(2).to_pylist()], length)
            place = runs.first - runs.base[runs.owner]
            lead = runs.anchor - runs.first
            owner = pa.array(runs.owner)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.hashes()),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array((place * _LEAD + lead) * _N + runs.n),
                ],
                ["hash", *_DOC, "run"],
            )

    return docs.select(*_DOC, "text").mapInArrow(
        find, "hash bigint, by_id bigint, by_text bigint, run bigint"
    )


def _cut_strings(
    run: list[int],
    piece: bytes,
    hashed: int,
    length: int,
    seen: dict[tuple[bytes, int], list[list]],
    sent: dict[bytes, int],
) -> list[list]:
    """The strings of a run, each as a run of one; those known to repeat have no text, and
    neighbours of them are one run."""
    by_id, by_text, place, lead, n, copies = run
    out: list[list] = []
    for k in range(n):
        string = piece[k : k + length]
        before = lead - k
        known = seen.get((string, before))
        for entry in known or ():
            entry[6] = 2
        if known is not None or sent.get(string, 0) > 1:
            if out and out[-1][7] is None:
                out[-1][5] += 1
            else:
                out.append([by_text ^ (place + k), by_id, by_text, place + k, before, 1, 2, None])
            continue
        if len(sent) >= _SENT:
            sent.clear()
        sent[string] = sent.get(string, 0) + 1
        key = xxhash.xxh64_intdigest(string, (hashed + before) % (1 << 64))
        key -= (key >> 63) << 64
        entry = [key, by_id, by_text, place + k, before, 1, copies, string]
        seen[string, before] = [entry]
        out.append(entry)
    return out


def _cut_runs(texts: DataFrame, length: int) -> DataFrame:
    """The text of each run in (id, document, text, copies, runs), of hot anchors (a negative
    run) of each string. Of equal ones of a batch the first has the text, and it counts as
    repeated; the others are known to repeat."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}  # texts of hot strings that went out, over all batches
        for batch in bounded(batches, "text"):
            out: list[list] = []
            seen: dict[tuple[bytes, int], list[list]] = {}
            for by_id, by_text, text, copies, runs in zip(*(c.to_pylist() for c in batch.columns[1:])):
                raw = text.encode()
                for hashed, run in ((run["hash"], run["run"]) for run in runs):
                    hot = run < 0
                    run = -1 - run if hot else run
                    place, lead, n = run // (_LEAD * _N), run // _N % _LEAD, run % _N
                    piece = raw[place : place + n - 1 + length]
                    known = seen.get((piece, lead))
                    if known is not None:
                        for entry in known:
                            entry[6] = 2
                        # Nothing is compared with it; its hash only spreads it.
                        out.append([by_text ^ place, by_id, by_text, place, lead, n, 2, None])
                    elif hot:
                        entries = _cut_strings(
                            [by_id, by_text, place, lead, n, copies], piece, hashed, length, seen, sent
                        )
                        out += entries
                        seen[piece, lead] = [entry for entry in entries if entry[7] is not None]
                    else:
                        entry = [hashed, by_id, by_text, place, lead, n, copies, piece]
                        seen[piece, lead] = [entry]
                        out.append(entry)
                    if len(out) >= _FLUSH:
                        yield rows(out)
                        out, seen = [], {}
            yield rows(out)

    def rows(out: list[list]) -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * 8
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names
        )

    names = ["hash", *_DOC, "place", "lead", "n", "copies", "text"]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
    return texts.mapInArrow(
        cut,
        "hash bigint, by_id bigint, by_text bigint, place bigint, lead int, n int, "
        "copies int, text binary",
    )


def _repeated_starts(
    hashes: np.ndarray, lead: np.ndarray, n: np.ndarray, copies: np.ndarray, runs: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """(run, string of the run) of the strings that repeat among runs sorted by hash."""
    data = np.frombuffer(b"".join(runs), np.uint8)
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    starts = np.cumsum(sizes) - sizes
    group = np.cumsum(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])

    # Whole runs: equal ones have the same anchor at the same place.
    order, part = sort_strings(data, starts, sizes, group * 1024 + lead)
    firsts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
    several = np.diff(np.append(firsts, len(part)))
    weight = np.add.reduceat(copies[order], firsts) if len(firsts) else several
    whole = np.zeros(len(runs), bool)
    whole[order] = np.repeat(weight > 1, several)
    stands = order[firsts]  # one run for all equal ones

    # Suffixes of the different runs of an anchor, if not all are known to repeat.
    per_group = np.bincount(group[stands], minlength=group[-1] + 1)
    open_group = np.bincount(group[stands], weights=~whole[stands], minlength=group[-1] + 1) > 0
    stands = stands[(per_group > 1)[group[stands]] & open_group[group[stands]]]
    run = np.repeat(stands, n[stands])
    string = ranges(np.zeros(len(stands), np.int64), n[stands])
    before = lead[run] - string  # bytes of the string before the anchor
    key = group[run] * 1024 + before
    order, part = sort_strings(data, starts[run] + string, np.full(len(run), length), key)
    same = part[1:] == part[:-1]
    shared = np.append(False, same)[: len(part)] | np.append(same, False)[: len(part)]
    again = order[shared]
    again = again[~whole[run[again]]]
    known = np.flatnonzero(whole)
    return (
        np.concatenate([run[again], np.repeat(known, n[known])]),
        np.concatenate([string[again], ranges(np.zeros(len(known), np.int64), n[known])]),
    )


def _sort_runs(runs: DataFrame, length: int) -> DataFrame:
    """(document, start, stop): stretches of bytes that repeat."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            hashes, place, lead, n, copies = (
                table.column(name).to_numpy().astype(np.int64)
                for name in ("hash", "place", "lead", "n", "copies")
            )
            texts = table.column("text")
            known = texts.is_null().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(~known)
            found, string = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(at):
                found, string = _repeated_starts(
                    hashes[at], lead[at], n[at], copies[at], texts.drop_null().to_pylist(), length
                )
                found = at[found]
            rest = np.flatnonzero(known)
            found = np.concatenate([found, np.repeat(rest, n[rest])])
            string = np.concatenate([string, ranges(np.zeros(len(rest), np.int64), n[rest])])
            order = np.lexsort((string, found))
            found, string = found[order], string[order]
            new = np.append(True, (np.diff(found) != 0) | (np.diff(string) != 1))[: len(found)]
            firsts = np.flatnonzero(new)
            start = (place[found] + string)[firsts]
            stop = start + np.diff(np.append(firsts, len(found))) - 1 + length
            owner = pa.array(found[firsts])
            yield pa.RecordBatch.from_arrays(
                [*(table.column(name).take(owner) for name in _DOC), pa.array(start), pa.array(stop)],
                [*_DOC, "start", "stop"],
            )

    return (
        runs.repartition("hash")
        .sortWithinPartitions("hash")
        .mapInArrow(sort, "by_id bigint, by_text bigint, start bigint, stop bigint")
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in blocks that end where a hash ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in bounded(batches, "text"):
        held.append(batch)
        size += batch.nbytes
        if size < _BLOCK:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        hashes = table.column(0).to_numpy()
        cut = int(np.searchsorted(hashes, hashes[-1]))  # sorted as signed numbers
        if cut:
            yield _one(table.slice(0, cut))
            table = table.slice(cut)
        held = table.combine_chunks().to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield _one(pa.Table.from_batches(held))


def _one(table: pa.Table) -> pa.RecordBatch:
    return table.combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def find_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text, copies, spans): a row for each row of `docs`; `copies` is 2 if another
    text is equal, else 1; `spans` are the (start, stop) in bytes that repeat, which may
    overlap. Of a text with copies all repeats, and the spans may be null."""
    if not _GRAM <= length <= 1000:
        raise ValueError(f"length must be from {_GRAM} to 1000")
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(key_of(id_col)).alias("by_id"),
        F.xxhash64(text_or_empty(text_col)).alias("by_text"),
        text_or_empty(text_col).alias("text"),
    )
    digests = materialize(source.select(*_DOC, F.sha2("text", 256).alias("sha")), "digests")
    # Groups of equal texts are written before they are joined: a join in the stage of its
    # own aggregate is not split, and one group may have a third of the rows.
    groups = materialize(
        digests.groupBy("sha")
        .agg(F.min(F.struct(*_DOC)).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "equal-texts",
        free=True,
    )
    # The first of equal texts goes on with their number; the others are known.
    standing = (
        digests.join(groups, "sha", "left")
        .select(
            *_DOC,
            F.coalesce(F.struct(*_DOC) == F.col("first"), F.lit(True)).alias("stands"),
            F.when(F.col("copies").isNull(), 1).otherwise(2).alias("copies"),
        )
        .dropDuplicates(_DOC)
    )
    texts = source.join(standing, _DOC)

    anchors = materialize(_find_anchors(source, length), "anchors")
    # Written for the same reason: the most common anchor may have a third of the rows.
    shared = materialize(
        anchors.groupBy("hash").agg(F.count("*").alias("uses")).where("uses > 1"), "shared-anchors", free=True
    )
    # Runs of hot anchors are marked by their sign.
    marked = F.when(F.col("uses") > _HOT, -1 - F.col("run")).otherwise(F.col("run"))
    runs = (
        anchors.join(shared, "hash")
        .select(*_DOC, "hash", marked.alias("run"))
        .groupBy(*_DOC)
        .agg(F.collect_set(F.struct("run", "hash")).alias("runs"))
    )
    standing_texts = texts.where("stands").join(runs, _DOC)
    # The id goes along so that this and the last join read the same shuffled texts.
    cut = _cut_runs(standing_texts.select("id", *_DOC, "text", "copies", "runs"), length)
    spans = (
        _sort_runs(cut, length)
        .groupBy(*_DOC)
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    return texts.join(spans, _DOC, "left").select(
        "id", "text", "copies", "spans"
    )


def drop_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, spans, kept): `spans` are the maximal runs of removed bytes as (start,
    stop), `kept` the remaining bytes."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            sizes, merged, kept = [], [], []
            for text, copies, spans in zip(*(c.to_pylist() for c in batch.columns[1:])):
                raw = text.encode()
                found = [(span["start"], span["stop"]) for span in spans or ()]
                if copies > 1 and len(raw) >= length:
                    found = [(0, len(raw))]
                found = _merged(found)
                at, rest = 0, []
                for start, stop in found:
                    rest.append(raw[at:start])
                    at = stop
                sizes.append(len(raw))
                merged.append([{"start": a, "stop": b} for a, b in found])
                kept.append(b"".join([*rest, raw[at:]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "n_bytes", "spans", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        find_repeats(docs, length, id_col, text_col)
        .select("id", "text", "copies", "spans")
        .mapInArrow(
            drop,
            f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary",
        )
        .withColumnRenamed("id", id_col)
    )


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out
