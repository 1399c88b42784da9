"""Secret scans with structural confirmation.

Patterns find assignments of passwords and tokens, access key ids and long hex strings.
Beyond those, base64 and hex candidates are decoded, and reported only if what they hold
is built like a secret: a DER private key whose nested lengths add up to its last byte, an
OpenSSH key whose strings do, armour around either, or a signed token whose header names its
algorithm, which may follow a name and a dot. Letters may run over lines, indented or quoted
ones too, and hex pairs may be parted by colons. An encrypted PEM key shows nothing of its
structure: its headers confirm it. PGP keys are confirmed by their first packet, PuTTY keys by
their counted lines.

Spans count code points, their end is exclusive. Kinds, in this order where spans start at
the same place: assign, access, hex (patterns), pem, der, ssh, jwt, pgp, ppk (confirmed). What
is armoured inside base64 or hex is pem or pgp.

Defined results: null and empty texts have no spans (and stay null or empty when masked);
repeated rows are scanned each; rows and other columns are kept as they are, and a column
of the same name as the result is replaced. Work grows with the length of a text, however
long it is, and a text has to fit in a task.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.llm.batches import bounded, fresh, text_or_empty

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt", "pgp", "ppk")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

# The patterns of the three base kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

# Line ends may be escaped, as in JSON.
_LINE_END = re.compile(r"(?:\\+r)?\\+n|\r?\n")
# What stands between two lines of letters: blanks and marks of a quotation may start a line.
_BREAK = rf"[ \t]*+(?:{_LINE_END.pattern})[ \t>]*+"
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----")
# The end of one string constant and the start of the next, and marks of quoted lines.
_JOINT = re.compile(r"""["'`]\s*+[+.,;&\\]?\s*+[bru]?["'`]""", re.IGNORECASE)
_QUOTED = re.compile(r"(?m)^[ \t]*+[>#*|][ \t>#*|]*+")
# Headers as in RFC 1421, which an encrypted key starts with.
_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
_CHECKSUM = re.compile(r"=[A-Za-z0-9+/]{4}$")
_TOKEN_START = re.compile(r"(?<![A-Za-z0-9])e[wy]")  # base64 of { and a quote or white space
_TOKEN_PART = re.compile(r"[A-Za-z0-9_-]*+")
_TOKEN_REST = re.compile(
    r"\.([A-Za-z0-9_-]*+)\.[A-Za-z0-9_-]*+(?:\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?"
)
_PUTTY = re.compile(r"PuTTY-User-Key-File-[123]: (\S+)\r?\nEncryption: \S+\r?\nComment: [^\r\n]*\r?\n")
_PUTTY_LINES = re.compile(r"(Public|Private)-Lines: (\d{1,6})\r?\n")
_PUTTY_OTHER = re.compile(r"(?:(?:Key-Derivation|Argon2-[A-Za-z]+): [^\r\n]*\r?\n)*+")
_PUTTY_LINE = re.compile(r"([A-Za-z0-9+/=]+)(?:\r?\n|$)")
_PUTTY_MAC = re.compile(r"Private-(?:MAC|Hash): [0-9a-f]+")

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
_SSH_MAGIC = b"openssh-key-v1\0"
_JSON = json.JSONDecoder(strict=False)


def _values(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the DER values that fill `data` to the last byte."""
    values, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            length = int.from_bytes(data[at : at + width], "big")
            at += width
        if at + length > len(data):
            return None
        values.append((tag, data[at : at + length]))
        at += length
    return values


def is_private_key(data: bytes) -> bool:
    """DER of a private key: PKCS#1, PKCS#8 (plain or encrypted), SEC1 or DSA."""
    outer = _values(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    inner = _values(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if tags[:2] == [_SEQUENCE, _OCTETS] and len(tags) == 2:  # encrypted PKCS#8
        return _starts_with_oid(inner[0][1]) and len(inner[1][1]) >= 16
    if tags[0] != _INTEGER or inner[0][1] not in (b"\0", b"\1"):
        return False
    if len(tags) >= 6 and set(tags[:9]) == {_INTEGER}:  # PKCS#1, DSA
        return len(tags) in (6, 9, 10) and max(len(value) for _, value in inner) >= 32
    if tags[1:3] == [_SEQUENCE, _OCTETS]:  # PKCS#8
        return _starts_with_oid(inner[1][1]) and len(inner[2][1]) >= 16
    if tags[1] == _OCTETS and 16 <= len(inner[1][1]) <= 66:  # SEC1
        return inner[0][1] == b"\1" and all(tag in (0xA0, 0xA1) for tag in tags[2:])
    return False


def _starts_with_oid(data: bytes) -> bool:
    values = _values(data)
    return bool(values) and values[0][0] == _OID and len(values[0][1]) > 0


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: its nested strings end where the data end."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            return None
        at += 4 + length
        return data[at - length : at]

    if any(string() is None for _ in range(3)) or at + 4 > len(data):
        return False
    n_keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= n_keys <= 1024:
        return False
    return all(string() for _ in range(n_keys + 1)) and at == len(data)


def is_pgp_key(data: bytes) -> bool:
    """Starts with a whole packet of a secret key of a known version."""
    if len(data) < 8 or not data[0] & 0x80:
        return False
    if data[0] & 0x40:
        tag, first = data[0] & 0x3F, data[1]
        if first < 192:
            at, size = 2, first
        elif first < 224:
            at, size = 3, ((first - 192) << 8) + data[2] + 192
        elif first == 255:
            at, size = 6, int.from_bytes(data[2:6], "big")
        else:
            return False
    else:
        tag, width = data[0] >> 2 & 0x0F, 1 << (data[0] & 3)
        at, size = 1 + width, int.from_bytes(data[1 : 1 + width], "big")
        if width == 8:  # until the end
            at, size = 1, len(data) - 1
    return tag == 5 and 6 < size <= len(data) - at and 2 <= data[at] <= 6


def _from_base64(text: str) -> bytes:
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _from_hex(text: str) -> bytes:
    return bytes.fromhex(text[: len(text) // 2 * 2])


def _json_object(text: str) -> dict:
    try:
        value = json.loads(_from_base64(text))
    except (ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def _is_object(text: str, start: int, stop: int) -> bool:
    """Whether the base64 from start to stop is that of a JSON object and no more. It reads
    no further than until the first fault, so that many starts of one part stay cheap."""
    size = 64
    while True:
        data = _from_base64(text[start : min(start + size, stop)]).decode("latin-1")
        whole = start + size >= stop
        try:
            value, end = _JSON.raw_decode(data)
        except json.JSONDecodeError as error:
            # An unfinished string is reported where it starts, other faults where they are.
            unfinished = error.msg.startswith("Unterminated") or error.pos >= len(data) - 8
            if whole or not data or not unfinished:
                return False
        except RecursionError:
            return False
        else:
            if whole or data[end:].strip():
                return isinstance(value, dict) and not data[end:].strip()
        size *= 4


def is_signed_token(header: str, payload: str) -> bool:
    names = _json_object(header)
    if not (isinstance(names.get("alg"), str) and names["alg"]):
        return False
    return isinstance(names.get("enc"), str) or bool(_json_object(payload)) or names.get("b64") is False


def _key_kind(data: bytes) -> str | None:
    return "der" if is_private_key(data) else "ssh" if is_ssh_key(data) else None


@dataclass(frozen=True)
class _Code:
    """A way to write bytes as letters, in pieces: lines, or pairs parted by colons."""

    inside: frozenset[str]  # signs that a key does not start behind
    start: re.Pattern[str]  # the first letters of what a key may start with
    gap: re.Pattern[str]
    run: re.Pattern[str]  # pieces and the gaps between them
    bits: int  # bits of a letter
    decode: Callable[[str], bytes]
    armour: list[tuple[re.Pattern[str], int]]  # letters of what armour holds, and those of a unit before
    long: re.Pattern[str]  # first letters of a run that may hold armour


def _code(
    letters: str, start: str, bits: int, decode: Callable[[str], bytes], colons: bool = False
) -> _Code:
    known = frozenset(chr(k) for k in range(128) if re.match(letters, chr(k)))
    piece, gap = (f"{letters}{{2}}", f":(?:{_BREAK})?+") if colons else (f"{letters}++", _BREAK)
    more = f"(?::{letters}{{2}}){{6}}" if colons else f"{letters}{{12}}"
    long = f"{piece}(?:{gap}{piece}){{63}}" if colons else f"{letters}{{40}}"
    return _Code(
        known | {":"} if colons else known,
        re.compile(f"(?:{start}){more}"),
        re.compile(gap),
        re.compile(f"{piece}(?:{gap}{piece})*+"),
        bits,
        decode,
        _ways(b"PRIVATE KEY", bits),
        re.compile(long),
    )


def _ways(data: bytes, bits: int) -> list[tuple[re.Pattern[str], int]]:
    """The letters sure to appear where `data` stand in encoded bytes, for each place that they
    may start at in a unit of whole bytes, and how many letters of the unit come before them."""
    if bits == 4:
        return [(re.compile(data.hex(), re.IGNORECASE), 0)]
    ways = []
    for k in range(3):
        letters = base64.b64encode(bytes(k) + data).decode()
        first = -(-8 * k // 6)
        ways.append((re.compile(re.escape(letters[first : (len(data) + k) * 8 // 6])), first))
    return ways


# A DER sequence or the magic of OpenSSH.
_CODES = [
    _code("[A-Za-z0-9+/_-]", "M[A-P]|b3Bl", 6, _from_base64),
    _code("[0-9A-Fa-f]", "30|6[Ff]70", 4, _from_hex),
    _code("[0-9A-Fa-f]", "30|6[Ff]:70", 4, _from_hex, colons=True),
]


class _Run:
    """Pieces of letters from one place of a text on, as one string."""

    def __init__(self, text: str, start: int, code: _Code):
        self.code = code
        self.stop = code.run.match(text, start).end()
        gaps = [m.span() for m in code.gap.finditer(text, start, self.stop)]
        self.starts = [start, *(end for _, end in gaps)]  # of pieces, in the text
        stops = [*(begin for begin, _ in gaps), self.stop]
        parts = [text[a:b] for a, b in zip(self.starts, stops)]
        self.joined = "".join(parts)
        self.ends, at = [], 0  # of pieces, in the string
        for part in parts:
            at += len(part)
            self.ends.append(at)

    def place(self, at: int) -> int:
        """The place in the text of a letter of the string."""
        piece = bisect_right(self.ends, at)
        return self.starts[piece] + at - (self.ends[piece - 1] if piece else 0)

    def armoured(self) -> Iterator[tuple[str, int, int]]:
        """(kind, start, end) of the armoured keys that the letters stand for."""
        bits, unit = self.code.bits, 4 if self.code.bits == 6 else 2
        ways = self.code.armour
        phases = {(m.start() - k) % unit for way, k in ways for m in way.finditer(self.joined)}
        for phase in sorted(phases):
            letters = self.joined[phase:]
            if len(letters) % unit == 1:
                letters = letters[:-1]
            for kind, start, end in _armoured(self.code.decode(letters).decode("latin-1")):
                last = phase - (-end * 8 // bits)
                yield kind, self.place(phase + start * 8 // bits), self.place(last - 1) + 1

    def key_at(self, start: int) -> tuple[str, int] | None:
        """Kind and end of the key that starts with the piece at `start`. Its length tells where
        it ends; only if a piece ends there, the whole of it is decoded."""
        line = bisect_right(self.starts, start) - 1
        first = self.ends[line - 1] if line else 0
        bits = self.code.bits

        def read(a: int, b: int) -> bytes:
            whole = a // 3 * 3
            letters = self.joined[first + whole * 8 // bits : first + -(-b // 3) * 24 // bits]
            return self.code.decode(letters)[a - whole : b - whole]

        size = _key_size(read)
        if size is None:
            return None
        end = first - (-size * 8 // bits)
        line = bisect_left(self.ends, end)
        if line == len(self.ends) or self.ends[line] != end:
            return None
        kind = _key_kind(self.code.decode(self.joined[first:end]))
        before = self.ends[line - 1] if line else 0
        return (kind, self.starts[line] + end - before) if kind else None


def _key_size(read: Callable[[int, int], bytes]) -> int | None:
    """Bytes of a key by its outer lengths; `read` gives the bytes from a to b."""
    head = read(0, len(_SSH_MAGIC))
    if head == _SSH_MAGIC:
        return _ssh_size(read)
    if len(head) < 8 or head[0] != _SEQUENCE:
        return None
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if width > 4 or head[1] == 0x80 or head[2 + width] not in (_INTEGER, _SEQUENCE):
        return None
    return 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])


def _ssh_size(read: Callable[[int, int], bytes]) -> int | None:
    at, left, counted = len(_SSH_MAGIC), 3, False
    while left or not counted:
        word = read(at, at + 4)
        if len(word) < 4:
            return None
        n = int.from_bytes(word, "big")
        at += 4
        if left:
            at, left = at + n, left - 1
        elif 1 <= n <= 1024:
            left, counted = n + 1, True
        else:
            return None
    return at


def _encoded_keys(
    text: str, code: _Code, covered: Callable[[int], bool]
) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the keys that start where letters start, line by line."""
    run, done = None, 0
    for m in code.start.finditer(text):
        start = m.start()
        inner = start and text[start - 1] in code.inside
        escaped = start > 1 and text.startswith("\\n", start - 2)
        if start < done or (inner and not escaped) or covered(start):
            continue
        if run is None or start >= run.stop:
            run = _Run(text, start, code)
        if key := run.key_at(start):
            kind, done = key
            while code.bits == 6 and text.startswith("=", done) and done < key[1] + 2:
                done += 1
            yield kind, start, done


def _armoured(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of keys between a line that begins them and the next, which ends them."""
    begin = None
    for m in _ARMOUR.finditer(text):
        if m[1] == "END" and begin and begin[2] == m[2]:
            if kind := _body_kind(text[begin.end() : m.start()], m[2]):
                yield kind, begin.start(), m.end()
        begin = m if m[1] == "BEGIN" else None


def _body_kind(body: str, label: str) -> str | None:
    body = _QUOTED.sub("", _LINE_END.sub("\n", _JOINT.sub("", body)))
    lines = [line.strip() for line in body.strip("\n").split("\n")]
    while lines and not lines[0]:
        del lines[0]
    n = 0
    if lines and _HEADER.match(lines[0]):
        if "" in lines:
            n = lines.index("")
        else:
            n = next((k for k, line in enumerate(lines) if not _HEADER.match(line)), len(lines))
    headers, letters = " ".join(lines[:n]), "".join(lines[n:])
    if label.startswith("PGP"):
        return "pgp" if is_pgp_key(_from_base64(_CHECKSUM.sub("", letters))) else None
    key = _from_base64(letters)
    encrypted = key and "Proc-Type" in headers and "ENCRYPTED" in headers
    return "pem" if _key_kind(key) or encrypted else None


def _putty_keys(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _PUTTY.finditer(text):
        at, blobs = m.end(), {}
        for name in ("Public", "Private"):
            at = _PUTTY_OTHER.match(text, at).end()
            count = _PUTTY_LINES.match(text, at)
            if not count or count[1] != name:
                break
            at, letters = count.end(), []
            while len(letters) < int(count[2]) and (line := _PUTTY_LINE.match(text, at)):
                letters.append(line[1])
                at = line.end()
            if len(letters) == int(count[2]):
                blobs[name] = _from_base64("".join(letters))
        if blobs.get("Private") and blobs.get("Public", b"")[4:].startswith(m[1].encode()):
            mac = _PUTTY_MAC.match(text, at)
            yield "ppk", m.start(), mac.end() if mac else at


def _tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Signed tokens: any part between dots may be the header, also behind a name."""
    stop, done, rest = 0, 0, None
    for m in _TOKEN_START.finditer(text):
        start = m.start()
        if start < done:
            continue
        if start >= stop:
            stop = _TOKEN_PART.match(text, start).end()
            rest = _TOKEN_REST.match(text, stop)
        if rest and stop - start >= 8 and _is_object(text, start, stop):
            if is_signed_token(text[start:stop], rest[1]):
                done = rest.end()
                yield "jwt", start, done


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret of one text, by start, then kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    armoured = list(_armoured(text)) if "PRIVATE KEY" in text else []
    begins = [start for _, start, _ in armoured]

    def covered(place: int) -> bool:
        before = bisect_right(begins, place)
        return before > 0 and place < armoured[before - 1][2]

    found += armoured
    for code in _CODES:
        found += _encoded_keys(text, code, covered)
        found += _encoded_armour(text, code)
    if "PuTTY-User-Key-File" in text:
        found += _putty_keys(text)
    if "." in text:
        found += _tokens(text)
    return sorted(set(found), key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def _encoded_armour(text: str, code: _Code) -> Iterator[tuple[str, int, int]]:
    stop = 0
    for m in code.long.finditer(text):
        if m.start() >= stop:
            run = _Run(text, m.start(), code)
            stop = run.stop
            yield from run.armoured()


def mask(text: str, spans: list[tuple[str, int, int]], sign: str = "[SECRET]") -> str:
    """The text with each stretch of spans, overlapping ones as one, replaced."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], sign]
        at = max(at, end)
    return "".join(out) + text[at:]


def _mapped(
    docs: DataFrame, text_col: str, name: str, kind: str, work: Callable[[str], object]
) -> DataFrame:
    """All columns of `docs` and `name`, made from the text; in its place if it exists,
    whatever the case of its letters."""
    places = [field for field in docs.schema.fields if field.name.lower() != name.lower()]
    scanned = fresh(docs, "scanned")
    source = docs.select(
        *(F.col(f"`{field.name}`") for field in places), text_or_empty(text_col).alias(scanned)
    )
    out_type = _arrow_type(kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, scanned):
            values = [work(text) for text in batch.column(scanned).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values, out_type)],
                [*(field.name for field in places), name],
            )

    # Types of nested fields keep their names, whatever signs these have.
    schema = T.StructType([*places, T.StructField(name, T.DataType.fromDDL(kind))])
    order = {column.lower(): column for column in [*docs.columns, name]}
    return source.mapInArrow(scan, schema).select(*(f"`{column}`" for column in order.values()))


def _arrow_type(kind: str) -> pa.DataType:
    if kind == "string":
        return pa.string()
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    return pa.list_(pa.struct(span))


def scan_secrets(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """`docs` with its secrets as an array of (kind, start, end) in column `name`."""

    def work(text: str) -> list[dict]:
        return [dict(zip(("kind", "start", "end"), span)) for span in find_secrets(text)]

    return _mapped(docs, text_col, name, SPANS, work)


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with every secret in the text replaced by a sign."""
    name = fresh(docs, "masked")
    hidden = _mapped(docs, text_col, name, "string", lambda text: mask(text, find_secrets(text)))
    masked = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(name))
    return hidden.withColumn(text_col, masked).drop(name)


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda span: F.concat_ws(
                ":", span["kind"], span["start"].cast("string"), span["end"].cast("string")
            ),
        ),
        ",",
    )
