"""Secret scan with structural confirmation.

Patterns find assignments, access keys and long hexadecimal runs. Base64, PEM and hexadecimal
candidates are decoded, and only what parses is added: a private key whose nested lengths fit
(PKCS#1, PKCS#8, SEC1, OpenSSH), or a signed token whose header and claims are JSON objects.

A row needs nothing but its own text, so there is no shuffle and no bound on the length of a text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_as_bytes

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "token", "key_pem", "key_base64", "key_hex"]
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

# Searched in the text with A-Z lower-cased, which keeps every offset.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
# The first segment is taken whole, with or without what has to follow, so that no run is read twice.
_TOKEN = re.compile(rb"eyJ[A-Za-z0-9_-]++(\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+)?")
_PEM = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_BASE64 = re.compile(rb"[A-Za-z0-9+/]{40,}={0,2}")
_HEX_ANY = re.compile(rb"(?:[0-9a-f]{64,}|[0-9A-F]{64,})")
_OPENSSH = b"openssh-key-v1\0"


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the content of the DER element at ``at``; None where it doesn't fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        width = n & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        n, at = int.from_bytes(data[at : at + width], "big"), at + width
        if n < 0x80:  # DER takes the short form here
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    found = []
    while start < end:
        if (e := _element(data, start, end)) is None:
            return None
        found.append(e)
        start = e[2]
    return found


def is_der_key(data: bytes) -> bool:
    """A private key as PKCS#1, SEC1 or PKCS#8, plain or encrypted, that fills ``data`` exactly."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    whole = lambda i: int.from_bytes(data[parts[i][1] : parts[i][2]], "big")
    if tags[0] == 0x02:
        if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # version, n, e, d, p, q, dp, dq, qinv
            return whole(0) <= 1 and parts[1][2] - parts[1][1] >= 32
        if tags[1:2] == [0x04]:  # version 1, private scalar
            return whole(0) == 1 and 16 <= parts[1][2] - parts[1][1] <= 66
        if tags[1:3] == [0x30, 0x04] and whole(0) <= 1:  # version, algorithm, key
            algorithm = _children(data, parts[1][1], parts[1][2])
            inner = _element(data, parts[2][1], parts[2][2])
            return bool(algorithm) and algorithm[0][0] == 0x06 and inner is not None and inner[2] == parts[2][2]
    if tags == [0x30, 0x04]:  # encrypted
        algorithm = _children(data, parts[0][1], parts[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(algorithm) == 2 and parts[1][2] - parts[1][1] >= 16
    return False


def is_openssh_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)

    def text() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if not text() or not text() or text() is None:  # cipher, derivation, its options
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16 or any(not text() for _ in range(keys)):
        return False
    return bool(text()) and at == len(data)


def _unbase64(run: bytes, url: bool = False) -> bytes | None:
    run = run.rstrip(b"=")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + b"=" * (-len(run) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(run: bytes) -> bool:
    head, claims, signature = run.split(b".")
    parts = []
    for part in (head, claims):
        raw = _unbase64(part, url=True)
        try:
            parts.append(json.loads(raw) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(p, dict) for p in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    return parts[0]["alg"].lower() == "none" or bool(signature) and _unbase64(signature, url=True) is not None


def _is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def find_secrets(text: bytes) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) as byte offsets, in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text.lower()) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found += [(m.start(), 3, m.end()) for m in _TOKEN.finditer(text) if m[1] and is_signed_token(m.group())]
    found += [(m.start(), 4, m.end()) for m in _PEM.finditer(text) if _is_key(_unbase64(b"".join(m[2].split())))]
    found += [(m.start(), 5, m.end()) for m in _BASE64.finditer(text) if _is_key(_unbase64(m.group()))]
    found += [(m.start(), 6, m.end()) for m in _HEX_ANY.finditer(text) if not len(m.group()) % 2 and _is_key(bytes.fromhex(m.group().decode()))]
    found.sort()
    return found


def _in_code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[dict]:
    at = {}
    if not text.isascii():
        before = points = 0
        for cut in sorted({x for start, _, end in found for x in (start, end)}):
            points += len(text[before:cut].decode())
            before = cut
            at[cut] = points
    return [{"kind": KINDS[k], "start": at.get(start, start), "end": at.get(end, end)} for start, k, end in found]


@F.arrow_udf(SPANS)
def _secrets(text: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([_in_code_points(t, find_secrets(t)) for t in texts_as_bytes(text)], kind)


def secrets(text: Column | str) -> Column:
    """Secrets of a text as an array of (kind, start, end) in code points, end exclusive.

    Ordered by start, then kind as in ``KINDS``. NULL and empty texts give an empty array. Spans of
    one kind never overlap; spans of different kinds may.
    """
    return _secrets(F.col(text) if isinstance(text, str) else text)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
