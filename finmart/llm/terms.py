"""Words of letters, digits and all characters beyond ASCII, in lower case (A-Z only)."""

from __future__ import annotations

from collections.abc import Iterator

CHUNK = 1 << 20  # bytes of text whose words are listed at once


def _sign(byte: int) -> int:
    inside = byte >= 0x80 or chr(byte).isalnum()
    return ord(chr(byte).lower()) if inside and byte < 0x80 else byte if inside else 0x20


# Each byte of a word, or a blank: bytes of UTF-8 beyond ASCII are never signs of their own.
_SIGNS = bytes(map(_sign, range(256)))


def words(text: bytes, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists; a list ends at the first blank after `chunk`
    bytes, so a word is never cut."""
    plain = text.translate(_SIGNS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + chunk)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end
