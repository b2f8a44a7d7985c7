"""Secret scans with structural confirmation.

Two passes over every whole text, in Arrow batches of bounded size:

* patterns: assignments to secret names, access ids and long hex strings;
* structure: runs that could be base64 or hex are decoded, and reported only if what they hold parses.
  ``jwt``: the first part of a dotted token decodes to a JSON object that names an algorithm, and the
  second to a JSON object. ``key``: the bytes are a private key container: an OpenSSH key (magic, then
  length-prefixed cipher, kdf, options and key count that fit), or DER, a SEQUENCE whose nested lengths
  fill it exactly and whose leading fields are those of a PKCS#1, PKCS#8, encrypted PKCS#8 or SEC1 key. A PEM frame
  around such bytes is part of the span. Line breaks within the base64 may be real or escaped (JSON, YAML, source
  strings), with or without a frame; without one, lines are joined up to the length the container states. Lines
  with marks other than quotes between them (``+``, ``#``, ``>``) are not joined.

Spans are ``kind:start:end`` in code points, end exclusive, sorted by start, then kind in the order of
``KINDS``. Null and empty texts have none. No shuffle; one row in, one row out, so repeated rows give
repeated results, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices

KINDS = ("assign", "access", "hex", "jwt", "key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
#: Every assignment holds one of these; looking for them first is much faster.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,64})-----")
BODY = re.compile(r"[A-Za-z0-9+/=\s:,\\-]*")
#: No container of a private key is larger.
MAX_KEY_BYTES = 1 << 16
#: Base64 in one run; shorter ones cannot hold a key.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
#: Where base64 of a SEQUENCE or of an OpenSSH key can start.
DER_START = re.compile(r"M[A-I][A-Za-z0-9+/_-]{14}")
SSH_START = "b3BlbnNzaC1rZXktdjE"
#: Base64 of a line, and the line breaks, real or escaped, with blanks and quotes around them. What stands behind the
#: look-behinds is never tried again from its middle.
RUN = r"(?:[A-Za-z0-9+/_-]|(?<!\\)\\++(?:/|u002[bBfF]))++"
BREAK = (
    r"""(?<![\x20\t"'])[\x20\t"']*+(?:(?:[\r\n]|(?<!\\)\\++(?:[nr\r\n]|u000[aAdD]))[\x20\t"']*+)++"""
)
LINES = re.compile(rf"({BREAK})|({RUN})((?:=|(?<!\\)\\++u003[dD]){{0,2}})")
ESCAPE = re.compile(r"(?<!\\)\\++(u00[0-9a-fA-F]{2}|[nrt/\r\n])")
LONG_HEX = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")


def decode_base64(text: str) -> bytes | None:
    plain = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def unescaped(text: str) -> str:
    """Escapes of line breaks, tabs, slashes and of single bytes, however often the backslash is doubled."""
    plain = {"n": "\n", "r": "\r", "t": "\t"}
    return ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] == "u" else plain.get(m[1], m[1]), text)


def der_length(start: str) -> int | None:
    """Bytes of the container whose base64 starts so, or None where its first field is none of a private key."""
    data = decode_base64(start[:16]) or b""
    size = data[1] & 0x7F if data[1:2] >= b"\x80" else 0
    if size > 4 or data[2 + size : 3 + size] not in (b"\x02", b"\x30"):
        return None
    return 2 + size + (int.from_bytes(data[2 : 2 + size], "big") if size else data[1])


@dataclass
class Block:
    """Lines of base64 that line breaks join, without escapes: their text, and where lines start and end in it."""

    base64: str
    starts: list[tuple[int, int]]  # place in the text, place in the block
    ends: dict[int, int]  # place in the block, place in the text behind the padding

    def bytes_at(self, start: int, at: int, size: int) -> bytes:
        """``size`` bytes from ``at`` of what the base64 from ``start`` holds, or fewer at the end."""
        chars = self.base64[start + at // 3 * 4 : start + ((at + size + 2) // 3) * 4]
        return (decode_base64(chars) or b"")[at % 3 :][:size]


def blocks(text: str) -> Iterator[Block]:
    """All of a text, each character once."""
    parts: list[str] = []
    starts: list[tuple[int, int]] = []
    ends: dict[int, int] = {}
    size, behind = 0, -1
    for m in LINES.finditer(text):
        gap, run, pad = m.groups()
        if gap is not None:
            behind = m.end() if m.start() == behind else -1
            continue
        if m.start() != behind and parts:
            yield Block("".join(parts), starts, ends)
            parts, starts, ends, size = [], [], {}, 0
        starts.append((m.start(), size))
        parts.append(unescaped(run))
        size += len(parts[-1])
        ends[size] = m.end()
        behind = -1 if pad else m.end()  # padding ends a container
    if parts:
        yield Block("".join(parts), starts, ends)


def openssh_length(block: Block, start: int) -> int | None:
    """Bytes of the OpenSSH key whose base64 starts there, by its length prefixes."""
    at, keys = len(b"openssh-key-v1\0"), 0

    def number() -> int:
        found = block.bytes_at(start, at, 4)
        return int.from_bytes(found, "big") if len(found) == 4 else MAX_KEY_BYTES

    for _ in range(3):  # cipher, kdf and kdf options
        at += 4 + number()
    keys = number()
    if not 1 <= keys <= 64:
        return None
    at += 4
    for _ in range(keys + 1):  # the public keys and the secret part
        at += 4 + number()
        if at > MAX_KEY_BYTES:
            return None
    return at


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """Keys without a frame, on one line or several: the base64 must end with a line, just where the container does."""
    found: list[tuple[int, int]] = []
    if not DER_START.search(text) and SSH_START not in text:
        return found
    for block in blocks(text):
        for place, start in block.starts:
            head = block.base64[start : start + 24]
            if DER_START.match(head):
                need = der_length(head)
            elif head.startswith(SSH_START):
                need = openssh_length(block, start)
            else:
                continue
            if need is None or need > MAX_KEY_BYTES:
                continue
            stop = start + (8 * need + 5) // 6
            if stop in block.ends and is_key(decode_base64(block.base64[start:stop])):
                found.append((place, block.ends[stop]))
    return found


def framed_keys(text: str) -> list[tuple[int, int]]:
    """Keys in a frame: an END mark, the BEGIN mark nearest before it, and a body between."""
    found: list[tuple[int, int]] = []
    begin: re.Match | None = None
    for mark in MARK.finditer(text):
        if mark[1] == "BEGIN":
            begin = mark
            continue
        if begin and begin[2] == mark[2] and BODY.fullmatch(text, begin.end(), mark.start()):
            body = unescaped(text[begin.end() : mark.start()])
            if is_key(decode_base64(re.sub(r"(?m)^[A-Za-z-]+: .*$", "", body))):  # headers of older containers
                found.append((begin.start(), mark.end()))
        begin = None
    return found


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of consecutive DER values that fill ``data`` exactly, or None."""
    fields, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data) or data[at] == 0:
                return None
            length = int.from_bytes(data[at : at + size], "big")
            if length < 0x80:
                return None
            at += size
        if at + length > len(data):
            return None
        fields.append((tag, data[at : at + length]))
        at += length
    return fields


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE with the leading fields of a private key, all nested lengths fitting."""
    outer = der_fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    fields = der_fields(outer[0][1])
    if not fields:
        return False
    for tag, content in fields:
        if tag & 0x20 and der_fields(content) is None:  # constructed values nest
            return False
    tags = [tag for tag, _ in fields]
    version = fields[0][1] if tags[0] == 0x02 else b""
    if version in (b"\x00", b"\x01") and tags[1:] == [0x02] * 8:
        return True  # PKCS#1: version and eight integers
    if version in (b"\x00", b"\x01") and tags[1:3] == [0x30, 0x04]:
        return (der_fields(fields[1][1]) or [(0, b"")])[0][0] == 0x06  # PKCS#8: algorithm, key
    if version == b"\x01" and tags[1:2] == [0x04]:
        return len(fields[1][1]) in (20, 24, 28, 32, 48, 66)  # SEC1: curve scalar
    if version == b"\x00" and tags[1:] == [0x02] * 5:
        return True  # DSA
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        return (der_fields(fields[0][1]) or [(0, b"")])[0][0] == 0x06
    return False


def is_openssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, parts = len(magic), []
    for _ in range(3):  # cipher, kdf and kdf options, each with its length
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return False
        parts.append(data[at : at + size])
        at += size
    keys = int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else 0
    return 0 < len(parts[0]) <= 64 and 1 <= keys <= 64


def is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 32 and (is_der_key(data) or is_openssh_key(data))


def is_signed_token(header: str, payload: str) -> bool:
    for part, needs in ((header, "alg"), (payload, None)):
        raw = decode_base64(part)
        try:
            value = json.loads(raw) if raw is not None else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or needs is not None and not isinstance(value.get(needs), str):
            return False
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns; matches never overlap within a kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def outside(taken: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that start in none of those taken."""
    taken = sorted(taken)
    ends = list(accumulate((b for _, b in taken), max))
    return [(a, b) for a, b in spans if not (k := bisect_right(taken, (a, len(ends) and ends[-1]))) or ends[k - 1] <= a]


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of runs whose decoded bytes parse."""
    found = []
    if "eyJ" in text:
        found += [(m.start(), 3, m.end()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    keys = framed_keys(text) if "-----BEGIN " in text else []
    keys += outside(keys, wrapped_keys(text))
    runs = [m.span() for m in BASE64.finditer(text)]
    keys += [(a, b) for a, b in outside(keys, runs) if is_key(decode_base64(text[a:b]))]
    found += [(a, 4, b) for a, b in keys]
    for m in LONG_HEX.finditer(text):
        if is_key(bytes.fromhex(m[0])):
            found.append((m.start(), 4, m.end()))
    return sorted(set(found))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_jwt bigint, n_key bigint,"
    " base_sha256 string, spans string"
)
ARROW = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in row_slices(batch):
            out: list[list] = [[] for _ in ARROW]
            for doc_id, text in zip(rows.column(0), rows.column(1), strict=True):
                base = base_spans(text := text.as_py() or "")
                spans = sorted(base + confirmed_spans(text))
                counts = [sum(s[1] == k for s in spans) for k in range(len(KINDS))]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                for column, value in zip(out, [doc_id.as_py(), *counts, digest, joined(spans)], strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, ARROW, strict=True)], schema=ARROW)


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts by kind, digest of the plain spans, and all spans."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_scan, SCHEMA)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))
