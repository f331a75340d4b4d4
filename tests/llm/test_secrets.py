from __future__ import annotations

import base64
import hashlib
import json
import re

from tidewater.llm import secrets as S


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (k := (n.bit_length() + 7) // 8)]) + n.to_bytes(k, "big")
    return bytes([tag]) + size + body


INT = tlv(2, b"\x01" * 32)
RSA = tlv(0x30, tlv(2, b"\0") + INT * 8)
PKCS8 = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(4, RSA))
PUBLIC = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x86\x48")) + tlv(3, b"\0" + INT * 2))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", b"k" * 32))
HEADER = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")


def plain_base(text):
    """The base patterns exactly as stated, then dropped if short."""
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, flags in (("assign", assign, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0)):
        for m in re.finditer(pattern, text, flags):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_structures():
    assert all(S.is_der_key(x) for x in (RSA, PKCS8, PUBLIC))
    assert not any(S.is_der_key(x) for x in (RSA[:-1], RSA + b"\0", b"", tlv(0x30, b"abc" * 30), tlv(4, RSA)))
    assert S.is_ssh_key(SSH) and not S.is_ssh_key(SSH[:-1]) and not S.is_ssh_key(b"\xff" * 60)
    assert S.is_token_header(HEADER) and not S.is_token_header("eyJub3BlIjoxfQ")


def test_spans_against_the_stated_patterns(frame):
    texts = [
        None,
        "",
        "é Token: 'abcdef12' AKIA" + "Z" * 16 + " x" + "0a" * 12,
        "password = short5 api_key=abcdefg AKIAAKIA" + "Q" * 12 + "kpasswd:" + "f" * 30,
        "AKIAshort " + "f" * 23 + " PASSWORD=\"'zzzzzz",
        "key " + base64.b64encode(PKCS8).decode() + " end",
        "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----",
        f"bearer {HEADER}.e30.c2ln and ssh-ed25519 " + base64.b64encode(SSH).decode(),
        RSA.hex() + " " + "ab" * 40,
        "clean words only " * 9000 + "secret=abcdefghij",
    ]
    got = {r.doc_id: r for r in S.scan(frame([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = plain_base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want.split(",") if x]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert set(want.split(",")) - {""} <= set(got[i].spans.split(","))
    more = {i: {x.split(":")[0] for x in got[i].spans.split(",")} & {"der", "ssh", "pem", "jwt"} for i in got}
    assert more[5] == {"der"} and "pem" in more[6] and more[7] == {"jwt", "ssh"} and more[8] == {"der"}
    assert not any(more[i] for i in (0, 1, 2, 3, 4, 9))


def test_empty_and_repeated(frame):
    assert S.scan(frame([])).collect() == []
    assert S.scan(frame([(None, "x", None, None), (1, "y", None, None), (1, "y", None, None)])).count() == 3


def key_of(oid, payload):
    return tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, bytes.fromhex(oid)) + tlv(5, b"")) + tlv(4, payload))


RSA_OID, EC_OID, ED_OID = "2a864886f70d010101", "2a8648ce3d0201", "2b6570"
EC = tlv(0x30, tlv(2, b"\1") + tlv(4, b"e" * 32))
SEALED = tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex("2a864886f70d01050d")) + tlv(0x30, tlv(5, b""))) + tlv(4, b"c" * 64))


def test_payloads_are_parsed_by_algorithm():
    assert S.is_der_key(key_of(RSA_OID, RSA)) and S.is_der_key(key_of(EC_OID, EC)) and S.is_der_key(key_of(ED_OID, tlv(4, b"s" * 32))) and S.is_der_key(SEALED)
    for oid in (RSA_OID, EC_OID, ED_OID, "2a8648ce380401", "2a0304"):
        assert not S.is_der_key(key_of(oid, bytes(range(100, 140))))  # 40 arbitrary bytes
    assert not S.is_der_key(key_of(RSA_OID, EC)) and not S.is_der_key(key_of(EC_OID, RSA)) and not S.is_der_key(key_of(ED_OID, tlv(4, b"s" * 31)))
    point = lambda body: tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex(EC_OID))) + tlv(3, b"\0" + body))
    assert S.is_der_key(point(b"\4" + b"p" * 64)) and not S.is_der_key(point(b"\7" + b"p" * 64))


def kinds(text):
    return {(k, text[a:b]) for k, a, b in S.confirmed_spans(text)}


def test_wrapped_prefixed_escaped_and_sealed_candidates():
    real = key_of(RSA_OID, RSA)
    flat, wrapped = base64.b64encode(real).decode(), base64.encodebytes(real).decode().strip()
    assert kinds(f"see\n{wrapped}\nend of it") == {("der", wrapped)}
    assert kinds(f"https://host/url/{flat} x") == {("der", flat)}
    assert kinds("a " + wrapped.replace("\n", "\\n") + " b") == {("der", wrapped.replace("\n", "\\n"))}
    block = f"-----BEGIN PRIVATE KEY-----\n{wrapped}\n-----END PRIVATE KEY-----"
    escaped = block.replace("\n", "\\n")
    assert ("pem", block) in kinds(f'x {block} y') and ("pem", escaped) in kinds('{"key": "' + escaped + '\\n"}')
    sealed = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n" + base64.encodebytes(b"x" * 64).decode() + "-----END RSA PRIVATE KEY-----"
    assert kinds(sealed) == {("pem", sealed)} and not kinds(sealed.replace("DEK-Info", "Other"))
    plain = "-----BEGIN RSA PRIVATE KEY-----\nComment: mine\n\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----"
    assert ("pem", plain) in kinds(plain)
    for body in ('{ "alg": "RS256"}', '{\n "alg":"none"}', '{"typ":"JWT","alg":"HS256"}'):
        token = base64.urlsafe_b64encode(body.encode()).decode().rstrip("=") + ".e30.c2ln"
        assert kinds(f"t={token}, x") == {("jwt", token)}
    assert kinds("0" + real.hex()) == {("der", real.hex())} and kinds(real.hex() + "f") == {("der", real.hex())}
    ssh = base64.b64encode(SSH).decode()
    assert kinds(f"path/{ssh} me@host") == {("ssh", ssh)}
    assert not kinds("M" + "A" * 400 + " AAAA" + "Q" * 300 + "\n" + "word " * 50)


def test_many_openings_without_an_end_stay_linear():
    import time

    text = "-----BEGIN PRIVATE KEY----- " * 20_000 + "MIIE" * 20_000 + "AAAAB3NzaC1y" * 10_000
    began = time.time()
    assert S.confirmed_spans(text) == [] and time.time() - began < 20
