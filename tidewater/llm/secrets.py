"""Secret scan with structural confirmation.

Three base kinds come from patterns alone (``assign``, ``access``, ``hex``).
Candidates in base64 or hex are decoded and reported only if their bytes parse:
DER key structures whose nested lengths fit exactly and whose inner octets are a key of
the algorithm named (``der``), length-prefixed SSH key blobs (``ssh``), armoured key
blocks, with headers or escaped line ends too (``pem``), and signed tokens whose header
is JSON naming an algorithm (``jwt``). Base64 may be wrapped over lines and follow a path's
slash; the first bytes of a key say how long it is.

Spans are ``kind:start:end`` in code points of the whole text, end exclusive,
ordered by start and then by kind as listed in ``KINDS``.

Defined results: null text is the empty text (no spans); texts of any length
are scanned whole; repeated rows and null ids give one row each; an empty table
gives none; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import id_text, joined_bytes, sliced, words

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "ssh", "pem", "jwt")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Where encoded keys may begin: a DER SEQUENCE, a length-prefixed SSH field, the private SSH start.
_DER_TEXT = re.compile(r"(?<![A-Za-z0-9])M[A-P][A-Za-z0-9+/_-]{6}")
_SSH_TEXT = re.compile(r"(?<![A-Za-z0-9])(?:AAAA[A-Za-z0-9+/_-]{8}|b3BlbnNzaC1rZXktdjE)")
_ENCODED = re.compile(r"[A-Za-z0-9+/_-]+")
#: A line's end within an encoded key, also as the two characters of an escaped one.
_BREAK = re.compile(r"[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}(?![0-9A-Fa-f])")
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----((?:[^-]|-(?!----))*+)-----END \1-----")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_KEYWORD = "(?i)passw|secret|token|api_?key"
#: Every other kind needs an unbroken run of at least this many of these bytes.
_RUN = 16
_RUN_BYTE = np.array([chr(b).isalnum() or chr(b) in "+/_-" if b < 128 else False for b in range(256)])


def unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly; None if they don't."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at : at + n], "big")
            if size < 128 or data[at] == 0:
                return None  # DER wants the shortest form
            at += n
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def der_size(data: bytes) -> int:
    """Bytes of the SEQUENCE that begins ``data``, by its own length; 0 if none does."""
    if len(data) < 6 or data[0] != 0x30:
        return 0
    if data[1] < 0x80:
        return 2 + data[1]
    n = data[1] & 0x7F
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 else 0


# Object identifiers (their DER content) of key algorithms and of password encryption.
_RSA, _EC = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201")
_EDWARDS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def _sequence(data: bytes) -> list[tuple[int, bytes]] | None:
    """The items of one whole SEQUENCE."""
    outer = der_items(data)
    return der_items(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == 0x30 else None


def _is_rsa_private(inner: list[tuple[int, bytes]] | None) -> bool:
    """Integers of an RSA or DSA private key."""
    return bool(inner) and len(inner) >= 6 and {t for t, _ in inner} == {0x02} and max(len(c) for _, c in inner) >= 16


def _is_rsa_public(inner: list[tuple[int, bytes]] | None) -> bool:
    """Modulus and exponent."""
    return bool(inner) and [t for t, _ in inner] == [0x02, 0x02] and len(inner[0][1]) >= 32 and len(inner[1][1]) <= 8


def _is_ec_private(inner: list[tuple[int, bytes]] | None) -> bool:
    return bool(inner) and [t for t, _ in inner[:2]] == [0x02, 0x04] and inner[0][1] == b"\x01" and len(inner[1][1]) >= 16


def _fits_private(algorithm: bytes, payload: bytes) -> bool:
    """Whether the octets of a private-key wrapper are a key of its algorithm."""
    if algorithm == _RSA:
        return _is_rsa_private(_sequence(payload))
    if algorithm == _EC:
        return _is_ec_private(_sequence(payload))
    inner = der_items(payload)
    if algorithm in _EDWARDS:
        return bool(inner) and [(t, len(c)) for t, c in inner] == [(0x04, _EDWARDS[algorithm])]
    # other algorithms: one value of its own (an integer, or integers in a sequence)
    return bool(inner) and len(inner) == 1 and inner[0][0] in (0x02, 0x04, 0x30) and len(payload) >= 16 and (inner[0][0] != 0x30 or bool(der_items(inner[0][1])))


def _fits_public(algorithm: bytes, bits: bytes) -> bool:
    if bits[:1] != b"\0":
        return False
    body = bits[1:]
    if algorithm == _RSA:
        return _is_rsa_public(_sequence(body))
    if algorithm == _EC:
        return (body[:1] == b"\x04" and len(body) % 2 == 1 and len(body) >= 33) or (body[:1] in (b"\x02", b"\x03") and len(body) >= 17)
    if algorithm in _EDWARDS:
        return len(body) == _EDWARDS[algorithm]
    return len(body) >= 16 and bool(der_items(body))


def is_der_key(data: bytes) -> bool:
    """A whole DER SEQUENCE laid out as a private or public key, its inner octets parsed by the algorithm named."""
    inner = _sequence(data)
    if not inner:
        return False
    if _is_rsa_private(inner) or _is_rsa_public(inner) or _is_ec_private(inner):
        return True
    private = inner[0][0] == 0x02 and len(inner) >= 3
    holder, payload = (inner[1], inner[2]) if private else (inner[0], inner[1] if len(inner) == 2 else (0, b""))
    algorithm = der_items(holder[1]) if holder[0] == 0x30 else None
    if not algorithm or algorithm[0][0] != 0x06:
        return False
    name = algorithm[0][1]
    if private:
        return payload[0] == 0x04 and _fits_private(name, payload[1])
    if name.startswith(_PASSWORD):  # encrypted under a password: whole cipher blocks
        return payload[0] == 0x04 and len(payload[1]) >= 16 and len(payload[1]) % 8 == 0 and len(algorithm) == 2
    return payload[0] == 0x03 and _fits_public(name, payload[1])


def is_ssh_key(data: bytes) -> bool:
    """An SSH key: a known start, then length-prefixed fields that fit exactly."""
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at, fields = len(magic), 0
        while fields < 3 and at + 4 <= len(data):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            fields += 1
        return fields == 3 and at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16
    at, parts = 0, []
    while at + 4 <= len(data) and len(parts) < 8:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        parts.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(parts) >= 2 and re.match(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+$", parts[0]) is not None


def is_token_header(text: str) -> bool:
    data = unbase64(text)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _encoded_run(text: str, at: int, need: int | None) -> tuple[str, int] | None:
    """(characters, end) of base64 that begins at ``at`` and may be wrapped over lines:
    exactly ``need`` characters, or all that follow."""
    parts, held, pos = [], 0, at
    while True:
        m = _ENCODED.match(text, pos)
        if m is None:
            return ("".join(parts), end) if parts and need is None else None
        take = len(m[0]) if need is None else min(len(m[0]), need - held)
        parts.append(m[0][:take])
        held, end = held + take, pos + take
        if held == need:
            return "".join(parts), end
        line = _BREAK.match(text, m.end())
        if line is None:
            return ("".join(parts), end) if need is None else None
        pos = line.end()


def _der_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Base64 whose first bytes are a SEQUENCE: its own length says where it ends."""
    for m in _DER_TEXT.finditer(text):
        size = der_size(unbase64(m[0]) or b"")
        if size < 30:
            continue
        found = _encoded_run(text, m.start(), -(-size * 8 // 6))
        if found is None:
            continue
        end = found[1] + min(-len(found[0]) % 4, len(text[found[1] : found[1] + 2]) - len(text[found[1] : found[1] + 2].lstrip("=")))
        if text[end : end + 1].isalnum():
            continue
        data = unbase64(found[0])
        if data and is_der_key(data[:size]):
            yield "der", m.start(), end


def _ssh_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _SSH_TEXT.finditer(text):
        line = _ENCODED.match(text, m.start())
        for body, end in ((line[0], line.end()), _encoded_run(text, m.start(), None)):
            data = unbase64(body)
            if data and is_ssh_key(data):
                pad = min(-len(body) % 4, len(text[end : end + 2]) - len(text[end : end + 2].lstrip("=")))
                yield "ssh", m.start(), end + pad
                break


def _hex_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _HEX_BYTES.finditer(text):
        for skip in (0, 1):  # of an odd run either end may be the stray digit
            digits = m[0][skip:]
            digits = digits[: len(digits) // 2 * 2]
            data = bytes.fromhex(digits)
            if is_der_key(data) or is_ssh_key(data):
                yield "der" if is_der_key(data) else "ssh", m.start() + skip, m.start() + skip + len(digits)
                break


def _is_armoured_key(body: str) -> bool:
    """The lines between armour: headers first, if any, then a key in base64."""
    lines = [x.strip() for x in body.replace("\\r", "").replace("\\n", "\n").splitlines()]
    headers = dict(x.split(":", 1) for x in lines if ":" in x)
    data = unbase64("".join(x for x in lines if ":" not in x).replace(" ", ""))
    if not data:
        return False
    if headers.get("Proc-Type", "").strip() == "4,ENCRYPTED":  # whole cipher blocks, the cipher and its start value named
        return re.fullmatch(r"\s*[A-Z0-9-]+,(?:[0-9A-Fa-f]{16}){1,2}", headers.get("DEK-Info", "")) is not None and len(data) >= 32 and len(data) % 8 == 0
    return is_der_key(data) or is_ssh_key(data)


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded bytes have the structure of a key or a signed token."""
    found = [("pem", *m.span()) for m in _ARMOUR.finditer(text) if _is_armoured_key(m[2])]
    found += [("jwt", *m.span()) for m in _SIGNED.finditer(text) if is_token_header(m[1])]
    return [*found, *_der_spans(text), *_ssh_spans(text), *_hex_spans(text)]


def written_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2])))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts per kind, the spans and their digest."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            texts = part.column("text")
            data, bounds = joined_bytes(texts)
            starts, ends, rows = words(data, bounds, _RUN_BYTE[data])
            worth = np.zeros(part.num_rows, bool)
            worth[rows[ends - starts >= _RUN]] = True
            keyword = np.asarray(pc.fill_null(pc.match_substring_regex(texts, _KEYWORD), False).to_numpy(zero_copy_only=False), bool)
            out: list[list] = [[] for _ in range(6)]
            for k in range(part.num_rows):
                text = texts[k].as_py() if worth[k] or keyword[k] else ""
                base = base_spans(text) if text else []
                more = confirmed_spans(text) if text and worth[k] else []
                kinds = [s[0] for s in base]
                row = (*(kinds.count(x) for x in BASE_KINDS), hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(base + more), len(more))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"],
            )

    return id_text(docs).mapInArrow(
        find, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_confirmed bigint"
    )
