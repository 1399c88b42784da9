"""SentencePiece encoding and decoding by vectorised merge rounds.

A BPE model merges, again and again, the leftmost of the adjacent symbols whose
concatenation is the best piece. Here a whole batch of words lies in flat arrays. In
each round a segmented minimum finds the best rank of every word, all words merge
at once, and the arrays are compacted; words without a pair leave. A worker encodes equal
words once.

A round passes over the whole of a word, so a word of many letters, such as a data URI, is
worked on by itself: its rounds take all places of the best rank from a list kept by rank,
merge those that cannot affect each other, and look up ranks next to a merge only. Places
affect each other if the letters between them can be reached by what either grows into
before others of their rank merge; `reach` is that number of letters for each rank.

The vocabulary file is read with the sentencepiece library; its encoder and decoder
are not used.

Defined results: null and empty texts have no ids and decode to ''. Every other column
is left out of the result, so clashing names do no harm; repeated rows stay repeated.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.batches import bounded, lists, ranges, text_or_empty
from finmart.llm.tiles import TileMemory

SPACE = "▁"
_NO_RANK = np.int64(1 << 40)
_LONG = 512  # letters from which on a word is worked on by itself


class PieceModel:
    """Merge table and pieces of a BPE vocabulary with byte fallback."""

    def __init__(self, path: str):
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = processor.get_piece_size()
        self.pieces = [processor.id_to_piece(i) for i in range(size)]
        self.is_byte = np.array([processor.is_byte(i) for i in range(size)])
        self.is_silent = np.array([processor.is_control(i) for i in range(size)])
        self.unknown = processor.unk_id()
        self.adds_space = processor.encode(SPACE, out_type=str) != [SPACE]
        normal = [
            i
            for i in range(size)
            if not (self.is_byte[i] or self.is_silent[i] or i == self.unknown)
        ]
        scores = sorted({processor.get_score(i) for i in normal}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(scores)}
        ids = {self.pieces[i]: i for i in normal}
        ranks = {i: rank_of[processor.get_score(i)] for i in normal}
        self.byte_ids = np.zeros(256, np.int64)
        for i in np.flatnonzero(self.is_byte):
            self.byte_ids[int(self.pieces[i][1:-1], 16)] = i

        # Symbols: the ids, then the letters that only occur inside pieces, then,
        # while encoding, letters that no piece has.
        self.symbols = dict(ids)
        self.letters: list[str] = []
        for piece in ids:
            for letter in piece:
                if letter not in self.symbols:
                    self.symbols[letter] = size + len(self.letters)
                    self.letters.append(letter)
        self.size = size
        self.n_symbols = size + len(self.letters) + 1
        self.foreign = self.n_symbols - 1

        self._merge_table(ids, ranks)
        # Texts may be cut where no piece crosses.
        several = [piece for piece in ids if len(piece) > 1]
        self.cuts_spaces = not any(SPACE in piece.lstrip(SPACE) for piece in several)
        self.cuts_lines = not any("\n" in piece for piece in several)

        parts = [self._surface(i) for i in range(size)]
        self.surface_lengths = np.array([len(part) for part in parts], np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.surface = np.frombuffer(b"".join(parts), np.uint8)

    def _merge_table(self, ids: dict[str, int], ranks: dict[int, int]) -> None:
        pairs: dict[int, int] = {}
        holders: dict[str, int] = {}  # best rank of the pieces made of this one and another
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in self.symbols and right in self.symbols:
                    key = self.symbols[left] * self.n_symbols + self.symbols[right]
                    pairs[key] = i
                    for part in (left, right):
                        holders[part] = min(holders.get(part, ranks[i]), ranks[i])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        merged = np.array([pairs[key] for key in self.pair_keys.tolist()], np.int64)
        self.pair_merged = merged
        self.pair_ranks = np.array([ranks[i] for i in merged.tolist()], np.int64)
        # A rank is simple if merging its piece never makes a better pair: then all
        # its places in a word may merge at once, and else only the leftmost.
        per_rank = np.bincount(list(ranks.values()))
        self.simple = per_rank == 1
        grown: dict[str, list[str]] = {}  # the pieces made of this one and another
        for piece in ids:
            for cut in range(1, len(piece)):
                if piece[:cut] in self.symbols and piece[cut:] in self.symbols:
                    grown.setdefault(piece[:cut], []).append(piece)
                    grown.setdefault(piece[cut:], []).append(piece)
        self.reach = np.zeros(len(per_rank), np.int64)
        for piece, i in ids.items():
            if holders.get(piece, _NO_RANK) <= ranks[i]:
                self.simple[ranks[i]] = False
                longest, open_pieces, seen = len(piece), [piece], {piece}
                while open_pieces:
                    for longer in grown.get(open_pieces.pop(), ()):
                        if longer not in seen and ranks[ids[longer]] <= ranks[i]:
                            seen.add(longer)
                            open_pieces.append(longer)
                            longest = max(longest, len(longer))
                self.reach[ranks[i]] = max(self.reach[ranks[i]], longest - len(piece))

    def _surface(self, i: int) -> bytes:
        if self.is_byte[i]:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.is_silent[i]:
            return b""
        if i == self.unknown:
            return " ⁇ ".encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def _symbols_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol and code point of each letter; where each word starts."""
        flat = "".join(words).replace(" ", SPACE)
        points = np.frombuffer(flat.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        distinct, inverse = np.unique(points, return_inverse=True)
        known = np.array(
            [self.symbols.get(chr(point), self.foreign) for point in distinct.tolist()],
            np.int64,
        )
        return known[inverse], points, np.repeat(np.arange(len(words)), lengths)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of symbols, and their places in the merge table."""
        keys = left * self.n_symbols + right
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[found] == keys, self.pair_ranks[found], _NO_RANK), found

    def _encode_long(self, word: str) -> np.ndarray:
        """Ids of one word, by rounds that look at the places of one rank."""
        symbols, points, _ = self._symbols_of([word])
        n = len(symbols)
        symbols = np.append(symbols, 0)
        # A symbol stands where its first letter is; the last place is beyond the word.
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive = np.ones(n + 1, bool)
        rank = np.full(n + 1, _NO_RANK)
        rank[: n - 1], _ = self._ranks_of(symbols[: n - 1], symbols[1:n])
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def remember(at: np.ndarray) -> None:
            at = at[rank[at] < _NO_RANK]
            by_rank = at[np.argsort(rank[at], kind="stable")]
            values, firsts = np.unique(rank[by_rank], return_index=True)
            for value, some in zip(values.tolist(), np.split(by_rank, firsts[1:])):
                if value not in places:
                    places[value] = []
                    heapq.heappush(queue, value)
                places[value].append(some)

        remember(np.arange(n - 1))
        while queue:
            best = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(best)))
            at = at[alive[at] & (rank[at] == best)]
            if not len(at):
                continue
            right = after[at]
            if self.simple[best]:
                # Pairs that overlap stand in a run; every other one of it merges.
                fresh = np.append(True, at[1:] != right[:-1])
                run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                chosen = (np.arange(len(at)) - run_start) % 2 == 0
            else:
                # The first of each group of places that may affect each other.
                chosen = np.append(True, at[1:] - after[right[:-1]] > 2 * self.reach[best])
                remember(at[~chosen])
            merging, gone = at[chosen], right[chosen]
            _, found = self._ranks_of(symbols[merging], symbols[gone])
            symbols[merging] = self.pair_merged[found]
            alive[gone] = False
            after[merging] = after[gone]
            before[after[merging]] = merging
            changed = np.unique(np.concatenate([merging, before[merging]]))
            changed = changed[(changed >= 0) & alive[changed]]
            rank[changed] = _NO_RANK
            changed = changed[after[changed] < n]
            rank[changed], _ = self._ranks_of(symbols[changed], symbols[after[changed]])
            remember(changed)
        left = np.flatnonzero(alive[:n])
        return self._ids(symbols[left], points[left], np.zeros(len(left), np.int64), 1)[0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        long = [k for k, word in enumerate(words) if len(word) >= _LONG]
        if not long:
            return self._encode_short(words)
        ids, lengths = self._encode_short(["" if len(word) >= _LONG else word for word in words])
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        for k in long:
            parts[k] = self._encode_long(words[k])
        return np.concatenate(parts), np.array([len(part) for part in parts], np.int64)

    def _encode_short(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        symbols, points, owner = self._symbols_of(words)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            keys = symbols[:-1] * self.n_symbols + symbols[1:]
            found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = (self.pair_keys[found] == keys) & (owner[:-1] == owner[1:])
            rank = np.where(hit, self.pair_ranks[found], _NO_RANK)
            rank = np.append(rank, _NO_RANK)  # one for each symbol: with its successor

            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(owner)))
            active = best < _NO_RANK
            if not active.all():
                resting = np.repeat(~active, lengths)
                done.append((owner[resting], symbols[resting], points[resting]))
                going = ~resting
                symbols, points, owner = symbols[going], points[going], owner[going]
                rank, found = rank[going], np.append(found, 0)[going]
                best, lengths = best[active], lengths[active]
                starts = np.cumsum(lengths) - lengths
                if not len(symbols):
                    break
            else:
                found = np.append(found, 0)

            chosen = np.flatnonzero(rank == np.repeat(best, lengths))
            word = np.searchsorted(starts, chosen, "right") - 1
            # Pairs that overlap stand in a run; every other one of it merges.
            fresh = np.append(True, (np.diff(chosen) > 1) | (np.diff(word) > 0))
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(chosen)), 0))
            even = (np.arange(len(chosen)) - run_start) % 2 == 0
            leftmost = np.append(True, np.diff(word) > 0)
            merging = chosen[np.where(self.simple[best[word]], even, leftmost)]

            symbols = symbols.copy()
            symbols[merging] = self.pair_merged[found[merging]]
            keep = np.ones(len(symbols), bool)
            keep[merging + 1] = False
            symbols, points, owner = symbols[keep], points[keep], owner[keep]
        done.append((owner, symbols, points))
        owner, symbols, points = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(owner, kind="stable")
        return self._ids(symbols[order], points[order], owner[order], len(words))

    def _ids(
        self, symbols: np.ndarray, points: np.ndarray, owner: np.ndarray, n_words: int
    ) -> tuple[np.ndarray, np.ndarray]:
        strange = np.flatnonzero(symbols >= self.size)
        if not len(strange):
            return symbols, np.bincount(owner, minlength=n_words)
        letters = [chr(point).encode() for point in points[strange].tolist()]
        counts = np.ones(len(symbols), np.int64)
        counts[strange] = [len(letter) for letter in letters]
        ids = np.repeat(symbols, counts)
        at = ranges((np.cumsum(counts) - counts)[strange], counts[strange])
        ids[at] = self.byte_ids[np.frombuffer(b"".join(letters), np.uint8)]
        per_word = np.bincount(owner, weights=counts, minlength=n_words)
        return ids, per_word.astype(np.int64)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Where a word may begin, in UTF-8 bytes: before a space, unless that follows a
        space or the last byte of its sign, and around line feeds."""
        marked = np.zeros(len(data), bool)
        if self.cuts_spaces:
            marked[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20) & (data[:-1] != 0x81)
        if self.cuts_lines:
            line_feed = data == 0x0A
            marked |= line_feed
            marked[1:] |= line_feed[:-1]
        return marked

    def decode(self, ids: np.ndarray) -> str:
        """The text of one sequence; a broken UTF-8 byte becomes U+FFFD."""
        lengths = self.surface_lengths[ids]
        raw = self.surface[ranges(self.surface_starts[ids], lengths)].tobytes()
        first = np.flatnonzero(~self.is_silent[ids])[:1]
        if self.adds_space and len(first) and self.pieces[ids[first[0]]][:1] == SPACE:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _each_broken_byte(raw)


def _each_broken_byte(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at : at + error.start].decode() + "�")
            at += error.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> TileMemory:
    model = piece_model(path)
    return TileMemory(model.cuts, model.encode_words)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has."""
    if piece_model(path).adds_space:
        filled = pc.not_equal(texts, "")
        texts = pc.if_else(filled, pc.binary_join_element_wise(" ", texts, ""), texts)
    return _memory(path).encode(texts)


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every whole text; no begin or end ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            ids, lengths = encode_texts(batch.column(1), model_path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(ids, lengths, pa.int32())], [id_col, "ids"]
            )

    source = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) for rows of `encode_pieces`; null ids decode to ''."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                ids = batch.column(1)
                values = ids.values.to_numpy(zero_copy_only=False)
                offsets = ids.offsets.to_numpy()
                texts = [model.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())],
                    [id_col, "ids", "decoded"],
                )

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        decode, f"`{id_col}` {kind}, ids array<int>, decoded string"
    )
