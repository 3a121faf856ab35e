"""Secret scans: patterns for candidates, structure for confirmation."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.shared import batches

#: Kinds in the order in which equal starts are listed; the first three need no structure, the last is listed but no secret.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh_public")
PUBLIC = ("ssh_public",)

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: A token begins where its alphabet does and gives no letter back, so each letter is read a few times at most.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
#: Between the markers: headers, base64, and line ends as such or escaped.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
_ENCRYPTED = re.compile(r"^DEK-Info:\s*[A-Z0-9-]+,[0-9A-Fa-f]{16,}\s*$", re.MULTILINE)
#: A line end, as such or as JSON and env files write it.
_ESCAPED = re.compile(r"\\+[nr]")
_BREAK = re.compile(r"[ \t]*(?:(?:[\r\n]|\\+[nr])[ \t]*)+")
#: DER begins with a sequence: 0x30, its length, and the tag of an integer or a sequence. Base64 shows lengths of up to
#: 127 bytes as MA to MH, with the tag behind, and longer ones (0x81 to 0x84) as MIE to MIT.
_DER = re.compile(r"M(?:[A-H][AEIMQUYcgkosw048][Cw]|I[E-T])")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]+")
#: Bytes of the shortest key.
_LEAST = 21
#: A marker of another kind than a private key's, right before a body.
_PUBLIC = re.compile(r"-----BEGIN (?![A-Z0-9 ]*PRIVATE KEY-----)[A-Z0-9 ]+-----(?:\s|\\+[nr])*\Z")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")
#: A length of under 64 KB before a key's name: AAAA in base64.
_SSH = re.compile(r"(?<![A-Za-z0-9+/])AAAA[A-Za-z0-9+/]{40,}+={0,2}")

Span = tuple[str, int, int]


def _padded(text: str) -> bytes | None:
    text = text.replace("-", "+").replace("_", "/").rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_length(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """(tag, start, end) of the element at ``at`` if it lies within ``data``."""
    if at + 2 > len(data):
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > len(data):
            return None
        size, start = int.from_bytes(data[start : start + n], "big"), start + n
        if size < 0x80:  # DER has one way to write a length
            return None
    return (tag, start, start + size) if start + size <= len(data) else None


#: Tags of DER elements.
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[start:end]`` exactly, or None."""
    found = []
    while start < end:
        element = der_length(data[:end], start)
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


def _names_algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    """A sequence that begins with an object identifier."""
    inner = der_length(data, element[1]) if element[0] == _SEQUENCE else None
    return inner is not None and inner[0] == _OID and inner[2] <= element[2]


def is_der_key(data: bytes | None) -> bool:
    """A private key: nested elements fit exactly and are those of one of the known forms.

    PKCS#1 and the older DSA form (a version and five or more integers), PKCS#8 (version,
    algorithm, octets), its encrypted form (algorithm, octets), SEC1 (version 1, octets) and PKCS#12
    (version 3, algorithm and content). Public keys, certificates and signatures are none.
    """
    if not data or not (top := der_length(data)) or top[0] != _SEQUENCE or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return False
    tags = [t for t, _, _ in parts]
    if tags[0] == _SEQUENCE:
        return tags == [_SEQUENCE, _OCTETS] and _names_algorithm(data, parts[0])
    if tags[0] != _INTEGER:
        return False
    version = int.from_bytes(data[parts[0][1] : parts[0][2]], "big")
    if tags[1] == _OCTETS:
        return version == 1
    if tags[1] == _SEQUENCE and _names_algorithm(data, parts[1]):
        return version in (0, 1) and tags[2:3] == [_OCTETS] or version == 3 and set(tags[2:]) <= {_SEQUENCE}
    return version in (0, 1) and len(tags) >= 6 and set(tags[:6]) == {_INTEGER}


def is_ssh_key(data: bytes | None) -> bool:
    """Fields with 32-bit lengths that fill ``data``; the first names a key type."""
    if not data:
        return False
    at, fields = 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or at + 4 > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and fields[0].startswith((b"ssh-", b"ecdsa-sha2-", b"sk-"))


def is_openssh_private(data: bytes | None) -> bool:
    return bool(data) and data.startswith(b"openssh-key-v1\x00") and len(data) > 40


def is_token_header(text: str) -> bool:
    """A signed token's first part: JSON that names an algorithm."""
    data = _padded(text)
    try:
        head = json.loads(data) if data else None
    except ValueError:
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def _pem_body(match: re.Match) -> bool:
    """Base64 of a key, or headers that name a cipher and base64 of whole blocks of it."""
    lines = _ESCAPED.sub("\n", match[2]).replace("\\/", "/").strip().split("\n")
    n = 0
    while n < len(lines) and (_HEADER.match(lines[n]) or n and lines[n][:1] in (" ", "\t")):  # a header may go on, indented
        n += 1
    data = _padded(re.sub(r"\s", "", "".join(lines[n:])))
    if n and _ENCRYPTED.search("\n".join(lines[:n])):
        return bool(data) and len(data) >= 16 and len(data) % 8 == 0
    return is_der_key(data) or is_openssh_private(data)


def _der_end(text: str, start: int) -> tuple[int, bool] | None:
    """(end, whether it is on one line) of the base64 of a DER key at ``start``: its own length says how far to read."""
    head = _padded(text[start : start + 8])
    if head is None or len(head) != 6:
        return None
    more = head[1] & 0x7F if head[1] & 0x80 else 0
    total = 2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1])
    left = -(-total * 4 // 3)
    if total < _LEAST or left > len(text) - start:
        return None
    at, parts = start, []
    while True:
        run = _BASE64.match(text, at, at + left)
        if run is None:
            return None
        parts.append(run[0])
        at, left = run.end(), left - len(run[0])
        if not left:
            break
        gap = _BREAK.match(text, at)
        if gap is None:
            return None
        at = gap.end()
    body = "".join(parts)
    follow = text[at : at + 1]
    if follow and (follow.isascii() and follow.isalnum() or follow in "+/" or follow in "-_" and ("-" in body or "_" in body)):
        return None
    data = _padded(body)
    if not is_der_key(data):
        return None
    while text[at : at + 1] == "=" and -len(body) % 4:
        at, body = at + 1, body + "="
    return at, len(parts) == 1


def _der_spans(text: str, pems: list[Span]) -> list[Span]:
    """Keys in base64 of either alphabet, also over several lines. What stands between markers is told by these:
    a confirmed key is not listed once more, except one of over 64 characters on one line; certificates are none."""
    found, done = [], 0
    for m in _DER.finditer(text):
        start = m.start()
        if start < done or (got := _der_end(text, start)) is None:
            continue
        end, single = got
        if not (single and end - start >= 87 and m[0][1] in "IH"):
            if any(a <= start < b for _, a, b in pems) or _PUBLIC.search(text, max(0, start - 100), start):
                continue
        found.append(("der", start, end))
        done = end
    return found


def base_spans(text: str) -> list[Span]:
    """Spans that a pattern alone decides: leftmost, without overlap within a kind, too short ones dropped after."""
    low = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    low += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    low += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return low


def confirmed_spans(text: str) -> list[Span]:
    """Spans whose decoded structure shows a key or a signed token."""
    found: list[Span] = []
    if "eyJ" in text:
        found += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if is_token_header(m[0].split(".")[0])]
    if "PRIVATE KEY-----" in text:
        found += [("pem", m.start(), m.end()) for m in _PEM.finditer(text) if _pem_body(m)]
    found += _der_spans(text, [s for s in found if s[0] == "pem"])
    if "AAAA" in text:
        found += [("ssh_public", m.start(), m.end()) for m in _SSH.finditer(text) if is_ssh_key(_padded(m[0]))]
    # a key written in hex digits of either case is reported as such too
    for a, b in sorted({m.span() for p in (_HEX, _HEX_KEY) for m in p.finditer(text)}) if "30" in text else ():
        if text.startswith("30", a) and (b - a) % 2 == 0 and b - a >= 64 and is_der_key(bytes.fromhex(text[a:b])):
            found.append(("der", a, b))
    return found


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind as listed. Null reads as empty."""
    text = text or ""
    order: Callable[[Span], tuple] = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + confirmed_spans(text), key=order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_assign, n_access, n_hex, n_confirmed, base_sha256, spans)`` of every row, in one pass.

    Offsets are code points, ends exclusive. Null and empty texts have no spans
    (the digest is that of the empty text); repeated rows are judged each; an empty
    table gives no rows; long texts are scanned whole.
    """
    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    schema = "i long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan(t) for t in batch.column(1).to_pylist()]
        count = lambda kind: pa.array([sum(k == kind for k, _, _ in base) for base, _ in rows], pa.int64())
        return pa.record_batch(
            [
                batch.column(0), count("assign"), count("access"), count("hex"),
                pa.array([len(every) - len(base) for base, every in rows], pa.int64()),
                pa.array([sha256(listed(base).encode()).hexdigest() for base, _ in rows]),
                pa.array([listed(every) for _, every in rows]),
            ],
            names=["i", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"],
        )

    return source.mapInArrow(batches(one), schema).withColumnRenamed("i", id_col)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every secret replaced, public keys left; overlapping spans are replaced as one."""
    if text is None:
        return None
    out, at = [], 0
    end = -1
    for kind, a, b in scan(text)[1]:
        if kind in PUBLIC:
            continue
        if a >= end:
            out += [text[at:a], mark]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets in its texts replaced; other columns, nulls and clean texts stay as they are."""

    def run(source):
        for batch in source:
            k = batch.schema.get_field_index(text_col)
            texts = pa.array([redacted(t) for t in batch.column(k).to_pylist()], batch.schema.field(k).type)
            yield batch.set_column(k, batch.schema.field(k), texts)

    return docs.mapInArrow(run, docs.schema)
