"""Token ids of whole texts with the tokenizers library, each distinct tile once.

The pre-tokenizers of both vocabularies always part letters from digits and from
punctuation (but for apostrophes, which may begin an English ending), and anything from
white space that follows it. Texts are cut at these places, so the ids of a text are
those of its tiles in a row. Only tiles that a worker has not seen yet reach the library.

Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from finmart.llm.tiles import TileMemory

_BLANK, _LETTER, _DIGIT, _MARK, _QUOTE, _OTHER, _WIDE = range(7)


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    for byte in range(128):
        letter = chr(byte)
        if letter in "\t\n\v\f\r ":
            table[byte] = _BLANK
        elif letter.isalpha():
            table[byte] = _LETTER
        elif letter.isdigit():
            table[byte] = _DIGIT
        elif letter == "'":
            table[byte] = _QUOTE
        else:
            table[byte] = _MARK
    return table


def _pairs() -> np.ndarray:
    table = np.zeros((7, 7), bool)
    table[[_LETTER, _DIGIT, _MARK, _QUOTE, _OTHER], _BLANK] = True
    for a, b in ((_LETTER, _DIGIT), (_LETTER, _MARK), (_DIGIT, _MARK)):
        table[a, b] = table[b, a] = True
    return table.ravel()


_CLASS, _PAIR = _classes(), _pairs()
_LEADS = np.isin(np.arange(256), (0xC2, 0xE1, 0xE2, 0xE3))


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a tile may begin, in UTF-8 bytes."""
    kinds = _CLASS[data]
    # Latin letters with accents: C3 80 to C3 BF, but for the signs of times and division.
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[~np.isin(data[lead + 1], (0x97, 0xB7))]
    kinds[lead] = kinds[lead + 1] = _LETTER
    # No cut between white space beyond ASCII and the white space after it.
    lead = np.flatnonzero(_LEADS[data])
    if len(lead):
        a, b, c = (
            np.where(lead + k < len(data), data[np.minimum(lead + k, len(data) - 1)], 0)
            for k in range(3)
        )
        kinds[lead[(a == 0xC2) & np.isin(b, (0x85, 0xA0))] + 1] = _WIDE
        wide = (
            ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
            | ((a == 0xE2) & (b == 0x80) & (np.isin(c, (0xA8, 0xA9, 0xAF)) | (c <= 0x8A)))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        )
        kinds[lead[wide] + 2] = _WIDE
    marked = np.zeros(len(data), bool)
    marked[1:] = _PAIR[kinds[:-1] * np.uint8(7) + kinds[1:]]
    return marked


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1
    letters stand for themselves, the others follow from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(byte) for byte in visible} | {
        byte: chr(256 + k) for k, byte in enumerate(hidden)
    }


class _Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.drops_blanks = self.tokenizer.normalizer is not None
        # A tile of Latin letters is one word to the pre-tokenizer: the model takes it.
        self.plain = re.compile("[ \n]?([A-Za-zÀ-ÖØ-öø-ÿ]+)" if self.drops_blanks else "( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)")
        letters = _byte_letters()
        self.letters = {chr(byte): letters[byte] for byte in range(128)}
        for point in range(0xC0, 0x100):
            self.letters[chr(point)] = "".join(letters[b] for b in chr(point).encode())
        self.table = str.maketrans(self.letters)

    def __call__(self, tiles: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list = [None] * len(tiles)
        rest = []
        plain, table, tokenize = self.plain.fullmatch, self.table, self.model.tokenize
        for k, text in enumerate(tiles):
            match = plain(text)
            if match:
                word = match[1].lower() if self.drops_blanks else match[1]
                found[k] = [token.id for token in tokenize(word.translate(table))]
            else:
                rest.append(k)
        encoded = self.tokenizer.encode_batch_fast(
            [tiles[k] for k in rest], add_special_tokens=False
        )
        for k, tokens in zip(rest, encoded):
            found[k] = tokens.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths


@lru_cache(maxsize=2)
def _memory(path: str) -> TileMemory:
    return TileMemory(cuts, _Encoder(path))


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encode_texts(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each followed by `end`, and how many each has."""
    ids, lengths = _memory(path).encode(texts)
    return np.insert(ids, np.cumsum(lengths), end), lengths + 1
