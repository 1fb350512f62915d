"""Secret scans with structural confirmation.

Base kinds come from plain rules (assign, access, hex). Beyond them, base64 and hex candidates are decoded, and a span is
reported only if what they hold parses: a signed token's header and payload as JSON objects (jwt), a private key whose
nested lengths add up to the last byte (key: PEM armour around one; der: bare), an OpenSSH key's nested strings (ssh), or
text that holds any of these itself, but not a bare hex run (encoded); text inside encoded text is followed ``DEPTH`` deep. Candidates may be
wrapped over lines, hex runs of odd length are read without their first or last digit, and keys encrypted by password count. Decoded
text is UTF-8 with white space but no other control codes. PEM bodies may have real or escaped line breaks of any kind. Offsets are code points, ends exclusive; spans of different kinds may overlap.

A null text counts as empty and has no spans; repeated rows are scanned one by one; an empty table stays empty; extra
columns pass through, and one called ``secrets`` is replaced. Each text is scanned whole, on its own, in one task.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import table

#: The kinds in the order that breaks ties of start; the first three are the base.
KINDS = ("assign", "access", "hex", "jwt", "key", "der", "ssh", "encoded")
BASE = KINDS[:3]
SPANS = "array<struct<kind:string,start:long,end:long>>"
MASK = "[SECRET]"

_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_HEXES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Fa-f])")
_HEX_ONLY = re.compile(r"[0-9A-Fa-f]+")
#: Lines of one candidate, all but the last of one length of 40 or more, as encoders wrap them.
_WRAPPED = re.compile(r"(?<![^\s])[A-Za-z0-9+/_-]{40,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}(?![^\s])")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(.*?)-----END \1-----", re.S)
#: Line breaks, also escaped once or more; codes that text doesn't have.
_BREAK = re.compile(r"(?:\\+r)?\\+n|\\+r|\r\n?")
_CONTROL = re.compile(r"[\0-\x08\x0e-\x1f\x7f-\x84\x86-\x9f]")
#: The beginnings of the identifiers of encryption by password (PKCS #5 and #12).
_PASSWORD = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")
_LONG, DEPTH = 20, 4


def _unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _nested(raw: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """The (tag, start, end) of the values from ``at``, if their lengths and those inside constructed ones fill it to ``end``."""
    found = []
    while at < end:
        if depth > 12 or at + 2 > end:
            return None
        tag, n, at = raw[at], raw[at + 1], at + 2
        if n >= 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            n, at = int.from_bytes(raw[at : at + k], "big"), at + k
        if at + n > end or (tag & 0x20 and _nested(raw, at, at + n, depth + 1) is None):
            return None
        found.append((tag, at, at + n))
        at += n
    return found


def private_der(raw: bytes) -> bool:
    """Whether the bytes are one private key: RSA's nine integers, an algorithm and its octets, a curve's octets, or one encrypted by password."""
    if len(raw) < 30 or raw[0] != 0x30:
        return False
    outer = _nested(raw, 0, len(raw))
    if not outer or len(outer) != 1:
        return False
    inner = _nested(raw, *outer[0][1:]) or []
    tags = [t for t, _, _ in inner]
    if tags == [0x30, 0x04]:
        # Encrypted: an algorithm that begins with its identifier, and whole blocks of octets.
        algorithm, octets = _nested(raw, *inner[0][1:]) or [], inner[1][2] - inner[1][1]
        return bool(algorithm) and algorithm[0][0] == 0x06 and raw[algorithm[0][1] : algorithm[0][2]].startswith(_PASSWORD) and octets >= 32 and octets % 8 == 0
    if not tags or tags[0] != 0x02 or raw[inner[0][1] : inner[0][2]] not in (b"\0", b"\1"):
        return False
    return len(tags) >= 9 and set(tags[:9]) == {0x02} or tags[1:3] == [0x30, 0x04] or tags[1:2] == [0x04]


def private_ssh(raw: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key whose nested strings end at the last byte."""
    magic = b"openssh-key-v1\0"
    if not raw.startswith(magic):
        return False
    at, keys = len(magic), 1

    def string(at: int) -> int:
        n = int.from_bytes(raw[at : at + 4], "big")
        return at + 4 + n if at + 4 + n <= len(raw) else -1

    for step in range(3):
        at = string(at)
        if at < 0:
            return False
    keys, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):
        at = string(at)
        if at < 0:
            return False
    return at == len(raw)


def signed_token(header: str, payload: str) -> bool:
    def parsed(part: str):
        try:
            return json.loads(_unbase64(part) or b"")
        except (ValueError, RecursionError):
            return None

    head = parsed(header)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(parsed(payload), dict)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the plain rules."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if max(map(len, text.split()), default=0) >= _LONG:
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def _kind(raw: bytes | None, depth: int) -> int | None:
    """The rank of the kind that decoded bytes confirm."""
    if not raw:
        return None
    if private_der(raw):
        return 5
    if private_ssh(raw):
        return 6
    if depth < DEPTH:
        try:
            text = raw.decode("utf-8-sig")
        except UnicodeDecodeError:
            return None
        if not _CONTROL.search(text) and any(kind != "hex" for kind, _, _ in find(text, depth + 1)):
            return 7
    return None


def _wrapped(text: str):
    """(start, end, bytes) of base64 and hex that goes on over lines; lines are of one length but for the last."""
    if "\n" not in text:
        return
    for m in _WRAPPED.finditer(text):
        lines = m[0].split()
        width = len(lines[0])
        last = next((k for k, line in enumerate(lines) if len(line) != width), len(lines) - 1)
        # What follows a shorter line, or comes with a longer one, is other text.
        last -= len(lines[last].rstrip("=")) > width
        if last < 1:
            continue
        taken, end = "".join(lines[: last + 1]), m.start()
        for line in lines[: last + 1]:
            end = text.index(line, end) + len(line)
        if _HEX_ONLY.fullmatch(taken) and len(taken) % 2 == 0:
            yield m.start(), end, bytes.fromhex(taken)
        else:
            yield m.start(), end, _unbase64(taken)


def _pem_body(body: str) -> bytes:
    """What a PEM body encodes, its headers left out."""
    lines = "\n".join(line.strip() for line in _BREAK.sub("\n", body).split("\n")).strip()
    return _unbase64("".join((lines.rpartition("\n\n")[2] if ":" in lines else lines).replace("\\/", "/").split())) or b""


def find(text: str | None, depth: int = 0) -> list[tuple[str, int, int]]:
    """All spans by start, then kind, of a text that was decoded ``depth`` times."""
    if not text:
        return []
    found = base_spans(text)
    armoured = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            raw = _pem_body(m[2])
            if private_der(raw) or private_ssh(raw) or ("ENCRYPTED" in m[1] + m[2] and len(raw) >= 32):
                armoured.append((m.start(), 4, m.end()))
    found += armoured
    if max(map(len, text.split()), default=0) >= _LONG:
        for m in _TOKEN.finditer(text):
            if signed_token(m[1], m[2]):
                found.append((m.start(), 3, m.end()))
        for m in _BASE64.finditer(text):
            if (kind := _kind(_unbase64(m[0]), depth)) is not None:
                found.append((m.start(), kind, m.end()))
        for m in _HEXES.finditer(text):
            # Of an odd run, either end may be no part of it.
            for start, end in ((m.start(), m.end()),) if len(m[0]) % 2 == 0 else ((m.start(), m.end() - 1), (m.start() + 1, m.end())):
                if (kind := _kind(bytes.fromhex(text[start:end]), depth)) is not None:
                    found.append((start, kind, end))
                    break
        for start, end, raw in _wrapped(text):
            # Armour reports its own body.
            if not any(s <= start and end <= e for s, _, e in armoured) and (kind := _kind(raw, depth)) is not None:
                # So does the whole for its lines.
                found = [f for f in found if f[1] < 5 or f[0] < start or f[2] > end] + [(start, kind, end)]
    return [(KINDS[k], s, e) for s, k, e in sorted(set(found))]


def redacted(text: str | None) -> str | None:
    """The text with each stretch that spans cover replaced by the mask."""
    if not text or not (spans := find(text)):
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at or not out:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _spans(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t.as_py())] for t in texts], kind)


def _redacted(texts: pa.Array) -> pa.Array:
    return pa.array([redacted(t.as_py()) for t in texts], pa.string())


def secrets(text: Column) -> Column:
    return F.arrow_udf(_spans, SPANS)(text)


def redact(text: Column) -> Column:
    return F.arrow_udf(_redacted, "string")(text)


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``secrets``: the spans of each text."""
    return docs.withColumn("secrets", secrets(F.col("text")))


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(*BASE)), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
