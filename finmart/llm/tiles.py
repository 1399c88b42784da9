"""Cutting texts into tiles that a tokenizer never looks across.

The tiles of a batch are one Arrow string array over the bytes of the texts themselves,
so nothing is copied, and its dictionary gives each distinct tile once. A cut between two
bytes depends on their classes only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from finmart.llm.batches import ranges


@dataclass
class Tiles:
    distinct: list[str]
    which: np.ndarray  # number of the distinct tile, for each tile in the order of the text
    per_text: np.ndarray  # tiles of each text


def tile(texts: pa.Array, cuts: Callable[[np.ndarray], np.ndarray]) -> Tiles:
    """`cuts` marks the bytes before which a tile may begin; null texts have no tiles."""
    texts = texts.fill_null("").cast(pa.string())
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    first, stop = int(offsets[0]), int(offsets[-1])
    if first == stop:
        return Tiles([], np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
    data = np.frombuffer(data_buffer, np.uint8)[first:stop]
    marked = cuts(data)
    begins = offsets[:-1] - first
    marked[begins[begins < len(data)]] = True
    starts = np.flatnonzero(marked)
    bounds = np.append(starts, len(data)).astype(np.int32)
    strings = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(bounds), pa.py_buffer(data)
    )
    encoded = strings.dictionary_encode()
    ends = np.searchsorted(starts, offsets[1:] - first)
    return Tiles(
        encoded.dictionary.to_pylist(),
        encoded.indices.to_numpy().astype(np.int64),
        np.diff(ends, prepend=0),
    )


class TileMemory:
    """Ids of the tiles that a worker has seen. `limit` bounds its memory: beyond it all
    are forgotten and learnt again when they next occur."""

    def __init__(
        self,
        cuts: Callable[[np.ndarray], np.ndarray],
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 150_000,
    ):
        self.cuts, self.learn, self.limit = cuts, encode, limit
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        tiles = tile(texts, self.cuts)
        if not tiles.distinct:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if len(self.number) > self.limit:
            self._clear()
        known = self.number
        fresh = [x for x in tiles.distinct if x not in known]
        if fresh:
            ids, lengths = self.learn(fresh)
            first = len(known)
            known.update(zip(fresh, range(first, first + len(fresh))))
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.lengths = np.concatenate([self.lengths, lengths])
        table = np.fromiter(map(known.__getitem__, tiles.distinct), np.int64, len(tiles.distinct))
        starts = (np.cumsum(self.lengths) - self.lengths)[table]
        lengths = self.lengths[table]
        long = lengths[tiles.which]
        ids = self.ids[ranges(starts[tiles.which], long)]
        ends = np.concatenate([[0], np.cumsum(long)])[np.cumsum(tiles.per_text)]
        return ids, np.diff(ends, prepend=0)
