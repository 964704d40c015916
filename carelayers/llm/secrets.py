"""Secrets in text: patterns, and encoded keys and tokens confirmed by their structure."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.llm.batches import hand_over_little, steps, texts

#: Kinds found by pattern alone, then those confirmed by structure; this is also their order.
PATTERN_KINDS = ("assign", "access", "hex")
KINDS = (*PATTERN_KINDS, "pem", "jwt", "key64", "keyhex")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

# The patterns, and how long a match must be.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN_LENGTH = 12
# A run that is long enough is the whole run, so the least length can be part of these patterns.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# Lines may also be broken by escapes, as in JSON: a backslash, or several, and the letter.
_PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----"
    r"((?:(?:\s|\\++[nr])++[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)*+)"
    r"((?:[A-Za-z0-9+/=\s]++|\\++[nr])++)-----END \1-----"
)
_LOCKED = re.compile(r"Proc-Type:\x20*4\x20*,\x20*ENCRYPTED")
_CIPHER = re.compile(r"DEK-Info:\x20*[A-Za-z0-9-]+\x20*,\x20*((?:[0-9A-Fa-f]{16}){1,2})(?![0-9A-Fa-f])")
_BREAKS = re.compile(r"\s+|\\+[nr]")
# Nothing shorter can be a header with an algorithm, claims and two dots.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]{19,}+")
# How the base64 of a JSON object begins: a brace, and a quote, blank or line break.
_OBJECT64 = ("eyJ", "ey", "ew")
# Encoded keys begin with a DER sequence (byte 30) or the name of the OpenSSH format.
_KEY64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nr]))(?:M[A-P]|b3Bl)[A-Za-z0-9+/_-]*+={0,2}")
_NEXT64 = re.compile(r"(?:[ \t]*+(?:[\r\n]|\\++[nr]))++[ \t]*+([A-Za-z0-9+/_-]++)")
_PAD64 = re.compile(r"={0,2}")
_KEYHEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70)[0-9A-Fa-f]{2,}+")
_NEXTHEX = re.compile(r"(?:[ \t]*+(?:[\r\n]|\\++[nr]))++[ \t]*+([0-9A-Fa-f]++)")
_KEY_BYTES = 18
# Fields of a key that are looked at; no key has more.
_FIELDS = 16
_SSH_NAME = b"openssh-key-v1\0"


def _decode64(text: str) -> bytes | None:
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


class _Encoded:
    """Bytes that are decoded from text where they are looked at: ``size`` from character ``at`` on."""

    def __init__(self, body: str, at: int, size: int, hexadecimal: bool):
        self.body, self.at, self.size, self.hexadecimal = body, at, size, hexadecimal

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int | slice) -> int | bytes:
        if isinstance(i, int):
            return self[i : i + 1][0]
        start, end, _ = i.indices(self.size)
        if start >= end:
            return b""
        if self.hexadecimal:
            return bytes.fromhex(self.body[self.at + 2 * start : self.at + 2 * end])
        first = start // 3
        part = self.body[self.at + 4 * first : self.at + 4 * -(-end // 3)]
        return (_decode64(part[:-1] if len(part) % 4 == 1 else part) or b"")[start - 3 * first : end - 3 * first]


def _element(data: bytes | _Encoded, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the DER element at ``at``, or None if it does not fit before ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        width = length & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        length, at = int.from_bytes(data[at : at + width], "big"), at + width
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes | _Encoded, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly, else None; also if they are too many for a key."""
    out = []
    while start < end:
        found = _element(data, start, end)
        if found is None or len(out) == _FIELDS:
            return None
        out.append(found)
        start = found[2]
    return out


# DER tags.
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_key(data: bytes | _Encoded) -> bool:
    """Whether ``data`` is one DER private key: all nested lengths fit, and the fields are a key's.

    RSA and DSA (a version and eight or five more integers), EC (version 1, octets), PKCS 8 (version,
    algorithm, octets) and encrypted PKCS 8 (algorithm, octets).
    """
    top = _element(data, 0, len(data))
    if top is None or top[0] != _SEQUENCE or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]

    def algorithm(part: tuple[int, int, int]) -> bool:
        inner = _children(data, part[1], part[2])
        return bool(inner) and inner[0][0] == _OID and inner[0][2] > inner[0][1]

    if tags == [_SEQUENCE, _OCTETS]:
        return algorithm(parts[0])
    if tags[0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    version = data[parts[0][1]]
    if all(t == _INTEGER for t in tags):
        return version <= 1 and len(tags) in (6, 9) and all(p[2] > p[1] for p in parts)
    if tags[1] == _OCTETS:
        return version == 1 and parts[1][2] - parts[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags[1] == _SEQUENCE and len(tags) > 2 and tags[2] == _OCTETS:
        return version <= 1 and algorithm(parts[1])
    return False


def is_ssh_key(data: bytes | _Encoded) -> bool:
    """Whether ``data`` is an OpenSSH private key: cipher, derivation, options, keys, private part."""
    if data[: len(_SSH_NAME)] != _SSH_NAME:
        return False

    def take(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if end <= len(data) else None

    at: int | None = len(_SSH_NAME)
    for _ in range(3):
        at = take(at)
        if at is None:
            return False
    if at + 4 > len(data):
        return False
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= count <= 64:
        return False
    for _ in range(count + 1):
        at = take(at)
        if at is None:
            return False
    return True


def _is_key(data: bytes | _Encoded | None) -> bool:
    return data is not None and (is_der_key(data) or is_ssh_key(data))


def _wanted(data: bytes | _Encoded) -> int | None:
    """Bytes of the key that begins with ``data``, or that are needed to know; None if none begins."""
    if data[0] == 0x30:
        if len(data) < 6:
            return 6
        width = data[1] & 0x7F if data[1] >= 0x80 else 0
        if data[1] >= 0x80 and not 1 <= width <= 4:
            return None
        return 2 + width + int.from_bytes(data[2 : 2 + width], "big") if width else 2 + data[1]
    if data[: len(_SSH_NAME)] != _SSH_NAME[: len(data)]:
        return None
    at, fields = len(_SSH_NAME), 3
    for part in range(2):  # cipher, derivation and options, then the keys and the private part
        for _ in range(fields):
            if at + 4 > len(data):
                return at + 4
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        if part == 0:
            if at + 4 > len(data):
                return at + 4
            fields, at = int.from_bytes(data[at : at + 4], "big") + 1, at + 4
            if not 2 <= fields <= 65:
                return None
    return at


class _Lines:
    """Encoded lines that follow each other, joined, and where each begins and ends in the text.

    Keys in them are looked up by their line, so that each line is read once however many begin a key.
    """

    def __init__(self, text: str, first: re.Match[str], following: re.Pattern[str]):
        lines, self.hexadecimal = [first[0]], following is _NEXTHEX
        self.starts, self.ends = {first.start(): 0}, {len(first[0]): first.end()}
        held, self.end = len(first[0]), first.end()
        while line := following.match(text, self.end):
            self.starts[line.start(1)] = held
            lines.append(line[1])
            held, self.end = held + len(line[1]), line.end()
            self.ends[held] = self.end
        self.body = "".join(lines)

    def key_end(self, start: int) -> int | None:
        """Where in the text the key ends that begins with the line at ``start``; its last line must end there."""
        at = self.starts[start]
        chars = len(self.body) - at
        data = _Encoded(self.body, at, chars // 2 if self.hexadecimal else chars * 3 // 4, self.hexadecimal)
        wanted = _wanted(data) if len(data) else None
        if wanted is None or not _KEY_BYTES <= wanted <= len(data):
            return None
        end = self.ends.get(at + (2 * wanted if self.hexadecimal else -(-wanted * 4 // 3)))
        if end is None or not _is_key(_Encoded(self.body, at, wanted, self.hexadecimal)):
            return None
        return end


def _keys(text: str, pattern: re.Pattern[str], following: re.Pattern[str], kind: str, armoured: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Encoded keys, on one line or, outside of ``armoured`` spans, on several."""
    past, lines, inside = 0, None, iter(armoured)
    span = next(inside, None)
    for m in pattern.finditer(text):
        start, end = m.span()
        if start < past:
            continue
        data = bytes.fromhex(m[0][: len(m[0]) // 2 * 2]) if following is _NEXTHEX else _decode64(m[0])
        whole = following is not _NEXTHEX or len(m[0]) % 2 == 0
        if whole and data is not None and len(data) >= _KEY_BYTES and _is_key(data):
            yield kind, start, end
            continue
        while span is not None and span[1] <= start:
            span = next(inside, None)
        if m[0][-1] == "=" or (span is not None and span[0] <= start):
            continue
        if lines is None or start not in lines.starts:
            lines = _Lines(text, m, following)
        last = lines.key_end(start)
        if last is not None:
            past = last
            yield kind, start, _PAD64.match(text, last).end() if following is _NEXT64 else last


def _armour(text: str) -> Iterator[tuple[str, int, int]]:
    """Armoured keys. Of one that its header says is encrypted, the cipher's blocks must be whole."""
    for m in _PEM.finditer(text):
        body = _decode64(_BREAKS.sub("", m[3]))
        cipher = _CIPHER.search(m[2]) if _LOCKED.search(m[2]) else None
        locked = cipher is not None and body and len(body) >= 16 and len(body) % (len(cipher[1]) // 2) == 0
        if locked or _is_key(body):
            yield "pem", *m.span()


def _tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Signed tokens: three parts between dots, the first from where an object may begin in it."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        ends = list(accumulate(len(p) + 1 for p in parts))
        i = 0
        while i + 2 < len(parts):
            head, claims = parts[i], parts[i + 1]
            starts = sorted({at for at in (head.find(o) for o in _OBJECT64) if at >= 0}) if claims else []
            for at in starts:
                if is_signed_token(f"{head[at:]}.{claims}.{parts[i + 2]}"):
                    yield "jwt", run.start() + ends[i] - 1 - len(head) + at, run.start() + ends[i + 2] - 1
                    i += 2
                    break
            i += 1


def is_signed_token(token: str) -> bool:
    """Whether header and claims are JSON objects and the header names an algorithm."""
    header, claims, _ = token.split(".")
    try:
        first, second = (json.loads(_decode64(p) or b"") for p in (header, claims))
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(second, dict) and isinstance(first.get("alg"), str)


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` in code points, by start and then kind."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LENGTH]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    spans += (pems := list(_armour(text)))
    spans += _tokens(text)
    armoured = [(start, end) for _, start, end in pems]
    spans += _keys(text, _KEY64, _NEXT64, "key64", armoured)
    spans += _keys(text, _KEYHEX, _NEXTHEX, "keyhex", armoured)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, text_col: str = "text", into: str = "spans") -> DataFrame:
    """Every row of ``docs`` with its spans in column ``into``, which replaces one of that name.

    Whole texts; NULL and empty texts have no spans; repeated rows and NULL ids are rows like any
    other. No shuffle; a lost task is done again by itself.
    """
    hand_over_little(docs.sparkSession)
    whole = docs.select(*[F.col(c) for c in docs.columns if c.lower() != into.lower()])
    text_at = whole.columns.index(text_col)
    schema = whole.withColumn(into, F.lit(None).cast(SPANS)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts(part.column(text_at))
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*part.schema.names, into])

    return whole.mapInArrow(run, schema)


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def redact(text: str, marker: str = "[redacted]") -> str:
    """``text`` with every span, and spans that overlap as one, replaced by ``marker``."""
    out, at = [], 0
    for _, start, end in find(text):
        if start >= at:
            out += [text[at:start], marker]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text", marker: str = "[redacted]") -> DataFrame:
    """Every row of ``docs`` with secrets in its text replaced; NULL stays NULL, other columns stay."""
    hand_over_little(docs.sparkSession)
    text_at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            clean = [t if t is None else redact(t, marker) for t in part.column(text_at).to_pylist()]
            arrays = list(part.columns)
            arrays[text_at] = pa.array(clean, part.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)
