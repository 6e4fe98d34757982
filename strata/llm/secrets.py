"""Secret scan with structural confirmation.

Three pattern kinds are reported as found: ``assign`` (a named credential and its
value), ``access`` (access key ids), ``hex`` (long hexadecimal runs). Candidates
that need proof are decoded and parsed first, and reported only if the parse ends
exactly where the data ends:

- ``jwt``: three base64url parts, a JSON header that names an algorithm, a JSON
  payload, a decodable signature;
- ``key``: PEM blocks, bare base64 and hexadecimal runs that hold a private key:
  DER with nested lengths (PKCS#1, PKCS#8, encrypted PKCS#8, SEC1, DSA) or the
  length-prefixed openssh-key-v1 container;
- ``encoded``: base64 or hexadecimal runs that decode to text with a secret in it.

A base64 candidate has at least the 16 characters that the shortest secret (12 bytes,
``token=abcdef``) takes. It is a run in one line, or consecutive lines of one length and a
last one that may be shorter; runs inside such a block are not reported again.

Spans are code points, end exclusive, ordered by start and then kind (as listed
here). Spans of different kinds may overlap.

Defined results: a null text is empty and has no spans; repeated rows get equal
results; whole texts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, free_name, prepare

KINDS = ["assign", "access", "hex", "jwt", "key", "encoded"]
SPANS = "array<struct<kind:string,start:int,end:int>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_BASE64 = 6, 20, 24, 16

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]+")
# Runs are taken whole and never given back ("++"), and none starts inside another, so that
# a text is read a fixed number of times however long its runs are.
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
_PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)(?=-----)")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_BASE64)
_BREAK = re.compile(r"[ \t]*+(?:\r?\n|\\r\\n|\\n)[ \t]*+")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+(?:%s[A-Za-z0-9+/_-]++={0,2})+"
                      % (LEAST_BASE64, _BREAK.pattern))

# A cheap look at the bytes says which patterns can match at all.
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MAP = bytes(104 if chr(c) in "0123456789abcdefABCDEF" else 32 for c in range(256))
_TOKEN_MAP = bytes(
    116 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_-.=") else 32 for c in range(256))


def _unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, begin, end) of the values that fill data[at:end] exactly, or None."""
    items = []
    while at < end:
        if at + 2 > end or data[at] & 31 == 31:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 128:
            width = size - 128
            if not 1 <= width <= 4 or at + width > end:
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
            if size < 128 or size >> 8 * (width - 1) == 0:
                return None   # not the shortest form
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


def _nested(data: bytes, at: int, end: int, depth: int = 0) -> bool:
    """Every constructed value below is filled exactly by its parts."""
    items = der_items(data, at, end)
    return items is not None and depth < 16 and all(
        not tag & 32 or _nested(data, a, b, depth + 1) for tag, a, b in items)


def is_der_private_key(data: bytes) -> bool:
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30 or not _nested(data, 0, len(data)):
        return False
    parts = der_items(data, *top[0][1:])
    tags = [tag for tag, _, _ in parts]
    inner = lambda i: [tag for tag, _, _ in der_items(data, *parts[i][1:])]
    if tags == [0x30, 0x04]:                                        # encrypted PKCS#8
        return inner(0)[:1] == [0x06]
    if not tags or tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1 or data[parts[0][1]] > 1:
        return False
    if tags[:3] == [0x02, 0x30, 0x04]:                              # PKCS#8
        return inner(1)[:1] == [0x06] and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:])
    if tags[:2] == [0x02, 0x04]:                                    # SEC1
        return parts[1][2] - parts[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return set(tags) == {0x02} and len(tags) in (6, 9)              # DSA, PKCS#1


def is_openssh_private_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, blobs = len(magic), 3
    done = 0
    while done < blobs:
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        done += 1
        if done == 3:            # cipher, kdf, kdf options; then the number of keys
            if at + 4 > len(data):
                return False
            keys = int.from_bytes(data[at:at + 4], "big")
            if not 1 <= keys <= 64:
                return False
            at, blobs = at + 4, 3 + keys + 1
    return at == len(data)


def is_private_key(data: bytes) -> bool:
    return is_openssh_private_key(data) or is_der_private_key(data)


def is_signed_token(text: str) -> bool:
    parts = text.split(".")
    if len(parts) != 3:
        return False
    raw = [_unbase64(p) for p in parts]
    if None in raw:
        return False
    try:
        header, payload = json.loads(raw[0]), json.loads(raw[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str) \
            or not isinstance(payload, dict):
        return False
    return (not raw[2]) == (header["alg"].lower() == "none")


def _hidden_text(data: bytes) -> bool:
    """Decoded bytes are printable text that holds a secret of another kind."""
    try:
        text = data.decode("ascii")
    except UnicodeDecodeError:
        return False
    return all(c.isprintable() or c in "\t\r\n" for c in text) and bool(scan(data, False))


def _wrapped(text: str):
    """(start, end, base64) of lines of one length that follow each other, with a shorter
    last line and without it."""
    for m in _WRAPPED.finditer(text):
        cuts = [m.start(), *(x for b in _BREAK.finditer(text, m.start(), m.end()) for x in b.span()), m.end()]
        lines = list(zip(cuts[::2], cuts[1::2]))
        at = 0
        while at < len(lines):
            begin, size = lines[at][0], lines[at][1] - lines[at][0]
            last = at
            while last + 1 < len(lines) and text[lines[last][1] - 1] != "=" \
                    and lines[last + 1][1] - lines[last + 1][0] == size:
                last += 1
            if size >= LEAST_BASE64:
                ends = [last] if last > at else []
                if last + 1 < len(lines) and text[lines[last][1] - 1] != "=" \
                        and lines[last + 1][1] - lines[last + 1][0] < size:
                    ends.insert(0, last + 1)
                for end in ends:
                    yield begin, lines[end][1], "".join(text[a:b] for a, b in lines[at:end + 1])
            at = last + 1


def _pem_blocks(text: str):
    """(start, end, body) of armoured keys: each BEGIN mark with the next END mark of its label,
    unless it lies in the block before."""
    ends: dict[str, list[int]] = {}
    begins = []
    for m in _PEM_MARK.finditer(text):
        if m[1] == "END":
            ends.setdefault(m[2], []).append(m.start())
        else:
            begins.append((m.start(), m.end() + 5, m[2]))
    done = 0
    for start, inside, label in begins:
        if start < done:
            continue
        places = ends.get(label, [])
        at = bisect_left(places, inside)
        if at < len(places):
            done = places[at] + len("-----END -----") + len(label)
            yield start, done, text[inside:places[at]]


class _Covered:
    """Whether a place lies in one of some spans."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def __contains__(self, place: int) -> bool:
        at = bisect_right(self.starts, place)
        return at > 0 and place < self.ends[at - 1]


def scan(raw: bytes, nested: bool = True) -> list[tuple[str, int, int]]:
    """Spans of one text (UTF-8), sorted."""
    lower = raw.lower()
    hex_map = raw.translate(_HEX_MAP)
    has_names = any(name in lower for name in _NAMES)
    has_hex = b"h" * LEAST_HEX in hex_map
    has_token = b"t" * LEAST_BASE64 in raw.translate(_TOKEN_MAP)
    has_access, has_pem = b"AKIA" in raw, b"-----BEGIN " in raw and b"-----END " in raw
    if not (has_names or has_hex or has_token or has_access or has_pem):
        return []
    text = raw.decode("utf-8", "replace")
    found: set[tuple[str, int, int]] = set()
    add = lambda kind, match: found.add((kind, match.start(), match.end()))
    if has_names:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                add("assign", m)
    if has_access:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                add("access", m)
    if has_hex:
        for m in _HEX.finditer(text):
            if m.end() - m.start() >= LEAST_HEX:
                add("hex", m)
        for m in _HEX_ANY.finditer(text):
            size = m.end() - m.start()
            if size >= LEAST_HEX and size % 2 == 0:
                data = bytes.fromhex(m[0])
                if is_private_key(data):
                    add("key", m)
                elif nested and _hidden_text(data):
                    add("encoded", m)
    blocks = []
    if has_pem:
        for begin, end, inside in _pem_blocks(text):
            data = _unbase64("".join(line for line in inside.replace("\\n", "\n").split() if ":" not in line))
            if data and is_private_key(data):
                found.add(("key", begin, end))
                blocks.append((begin, end))
    if has_token:
        for m in _SIGNED.finditer(text):
            if m.end() - m.start() >= LEAST_HEX and is_signed_token(m[0]):
                add("jwt", m)
        armoured, until = _Covered(blocks), 0
        for begin, end, body in _wrapped(text):
            if begin in armoured or begin < until:
                continue
            data = _unbase64(body)
            kind = "key" if data and is_private_key(data) else \
                "encoded" if data and nested and _hidden_text(data) else None
            if kind:
                found.add((kind, begin, end))
                blocks.append((begin, end))
                until = max(until, end)          # spans come in order of their start
        covered = _Covered(blocks)
        for m in _BASE64.finditer(text):
            if m.start() in covered:
                continue
            data = _unbase64(m[0])
            if data and is_private_key(data):
                add("key", m)
            elif data and nested and _hidden_text(data):
                add("encoded", m)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, *, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): array of kind, start, end."""
    prepare(docs.sparkSession)

    def run(text: pa.Array) -> pa.Array:
        return pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] if t else []
             for t in text.cast(pa.binary()).to_pylist()], _TYPE)

    name = free_name("_spans", docs)
    return docs.withColumn(name, arrow_column(run, SPANS)(F.col(f"`{text_col}`").cast("string"))), name


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets (overlapping
    spans become one, named by the first)."""
    prepare(docs.sparkSession)

    def run(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            parts, at, until = [], 0, 0
            for kind, a, b in scan(t.encode()) if t else []:
                if a >= until:
                    parts += [t[at:a], f"[{kind}]"]
                at = until = max(until, b)
            out.append(None if t is None else "".join(parts) + t[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, arrow_column(run, "string")(F.col(f"`{text_col}`").cast("string")))
