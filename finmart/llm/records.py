"""Token ids in files of length-delimited binary records.

A record is framed as: length of the payload (8 bytes), masked checksum of these 8 bytes
(4), payload, masked checksum of the payload (4); numbers are little-endian. A payload is
the document id (8 bytes), 1 if that is null (1), bytes per token id (1), then the ids. The
checksum is CRC-32, masked by a rotation by 15 bits and a constant, as a checksum of data
that holds checksums would be weak.

A shard `*.rec` has an index `*.idx` beside it: for each record its document id and null
mark, position, length in bytes, first token and number of tokens, as six 8-byte numbers,
and at the end the masked checksum of all that. A reader in any order needs only the index
and one ranged read for each record.

Shards are written by tasks under names that no other attempt uses; the manifest, a
Parquet table, is committed by Spark and names the shards of the attempts that count. A
task that is run again leaves an unnamed file at worst, so lost executors do no harm.

Defined results: a null or empty text is a record with the end id only; rows with a null
id come first; repeated ids are separate records in the order of their texts. No rows
give a manifest without shards, and reading it gives no rows. Columns other than the id
and the text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm.batches import bounded, lists, open_folder, qualified, text_or_empty
from finmart.llm.tokens import encode_texts, vocabulary_size

# Fixed values of the usual masked checksum.
_MASK_SHIFT, _MASK_DELTA = 15, 0xA282EAD8

_HEAD_SIZE, _TAIL_SIZE = 12, 4
_INDEX_FIELDS = 6


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> _MASK_SHIFT | crc << 32 - _MASK_SHIFT) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _check(length), payload, _check(payload)))


def _check(data: bytes) -> bytes:
    return struct.pack("<I", masked(data))


def unframe(data: bytes) -> bytes:
    """The payload of a frame."""
    payload = data[_HEAD_SIZE:-_TAIL_SIZE]
    if data[8:_HEAD_SIZE] != _check(data[:8]) or len(payload) != struct.unpack("<Q", data[:8])[0]:
        raise ValueError("broken length of a record")
    if data[-_TAIL_SIZE:] != _check(payload):
        raise ValueError("broken record")
    return payload


def _payload(key: int | None, width: int, ids: bytes) -> bytes:
    return struct.pack("<qBB", key or 0, key is None, width) + ids


def _ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, is_null, width = struct.unpack_from("<qBB", payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize("<qBB"))
    return None if is_null else key, ids


def write_token_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append `end_id`, and write shards, indexes and manifest
    below `folder`, which all executors share. Records follow each other by id."""
    place = qualified(docs.sparkSession, folder)
    width = 2 if vocabulary_size(tokenizer) <= 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        system, root = open_folder(place)
        name = f"part-{shard:06d}-{uuid.uuid4().hex}"
        out, position, start, entries = None, 0, 0, []
        for batch in bounded(batches, "text"):
            if out is None:
                system.create_dir(f"{root}/shards", recursive=True)
                out = system.open_output_stream(f"{root}/shards/{name}.rec")
            ids, lengths = encode_texts(batch.column(1), tokenizer, end_id)
            raw = ids.astype(f"<u{width}").tobytes()
            at = 0
            for key, length in zip(batch.column(0).to_pylist(), lengths.tolist()):
                record = frame(_payload(key, width, raw[at : at + length * width]))
                out.write(record)
                entries.append((key or 0, key is None, position, len(record), start, length))
                at += length * width
                position += len(record)
                start += length
        if out is None:
            return
        out.close()
        index = np.array(entries, "<i8").tobytes()
        with system.open_output_stream(f"{root}/shards/{name}.idx") as out:
            out.write(index + _check(index))
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "name": [name], "n_records": [len(entries)], "n_tokens": [start]}
        )

    text = text_or_empty(text_col)
    (
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
        # Equal ids are spread by their texts.
        .withColumn("salt", F.xxhash64("text"))
        .repartitionByRange("id", "salt")
        .sortWithinPartitions("id", "salt", "text")
        .select("id", "text")
        .mapInArrow(write, "shard bigint, name string, n_records bigint, n_tokens bigint")
        .write.parquet(f"{folder.rstrip('/')}/manifest")
    )


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard with the number of tokens in earlier ones; the driver sees one
    row for each write task, and no more."""
    rows = sorted(spark.read.parquet(f"{folder.rstrip('/')}/manifest").collect())
    before = accumulate((row.n_tokens for row in rows), initial=0)
    named = [(row.name, first) for row, first in zip(rows, before)]
    shards = spark.createDataFrame(named, "name string, first bigint")
    return shards.repartition(max(1, len(named)))


def read_token_records(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) of every record: `start` counts the ids of all records before it.
    Checksums are verified; a broken record is an error."""
    place = qualified(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(place)
        for batch in batches:
            for name, first in zip(*(column.to_pylist() for column in batch.columns)):
                with system.open_input_stream(f"{root}/shards/{name}.rec", buffer_size=1 << 20) as file:
                    yield from _batches(_frames(file), first, id_col)

    shards = _shards(spark, folder)
    return shards.mapInArrow(read, f"`{id_col}` bigint, start bigint, ids array<int>")


def _frames(file) -> Iterator[tuple[int | None, np.ndarray]]:
    while head := file.read(_HEAD_SIZE):
        if head[8:] != _check(head[:8]):
            raise ValueError("broken length of a record")
        rest = file.read(struct.unpack("<Q", head[:8])[0] + _TAIL_SIZE)
        yield _ids_of(unframe(head + rest))


def _batches(records, start: int, id_col: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    keys, starts, parts, size = [], [], [], 0

    def batch() -> pa.RecordBatch:
        lengths = np.array([len(part) for part in parts], np.int64)
        ids = lists(np.concatenate(parts).astype(np.int32), lengths, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), ids],
            [id_col, "start", "ids"],
        )

    for key, ids in records:
        keys.append(key)
        starts.append(start)
        parts.append(ids)
        start += len(ids)
        size += len(ids)
        if size >= most:
            yield batch()
            keys, starts, parts, size = [], [], [], 0
    if parts:
        yield batch()


def read_index(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per record: (id, name of the shard, position, size, start, n_tokens)."""
    place = qualified(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(place)
        for batch in batches:
            for name, first in zip(*(column.to_pylist() for column in batch.columns)):
                with system.open_input_stream(f"{root}/shards/{name}.idx") as file:
                    data = file.read()
                if _check(data[:-_TAIL_SIZE]) != data[-_TAIL_SIZE:]:
                    raise ValueError(f"broken index {name}")
                table = np.frombuffer(data[:-_TAIL_SIZE], "<i8").reshape(-1, _INDEX_FIELDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(table[:, 0], mask=table[:, 1] == 1),
                        pa.array([name] * len(table)),
                        *(pa.array(np.ascontiguousarray(table[:, k])) for k in (2, 3)),
                        pa.array(table[:, 4] + first),
                        pa.array(np.ascontiguousarray(table[:, 5])),
                    ],
                    [id_col, "name", "position", "size", "start", "n_tokens"],
                )

    return _shards(spark, folder).mapInArrow(
        read,
        f"`{id_col}` bigint, name string, position bigint, size bigint, start bigint, "
        "n_tokens bigint",
    )


def read_at(index: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) of the records in `index`, some rows of `read_index` in any order,
    by one ranged read each."""
    place = qualified(index.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(place)
        files: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["name"] not in files:
                    if len(files) == 64:
                        files.pop(next(iter(files))).close()
                    files[row["name"]] = system.open_input_file(f"{root}/shards/{row['name']}.rec")
                file = files[row["name"]]
                file.seek(row["position"])
                yield from _batches(
                    [_ids_of(unframe(file.read(row["size"])))], row["start"], id_col
                )

    return index.select("name", "position", "size", "start").mapInArrow(
        read, f"`{id_col}` bigint, start bigint, ids array<int>"
    )
