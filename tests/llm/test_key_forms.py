"""Private keys in their known forms, what only looks like one, and long runs of candidates."""

import base64
import json
import time

import pytest

from farelane.llm import secrets


def element(tag: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def number(n: int) -> bytes:
    return element(0x02, n.to_bytes(n.bit_length() // 8 + 1, "big"))


BIG = int.from_bytes(bytes(range(1, 65)), "big")
ALGORITHM = element(0x30, element(0x06, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01"), element(0x05))
OCTETS, BITS = element(0x04, bytes(range(48))), element(0x03, b"\x00" + bytes(range(64)))
PRIVATE = {
    "rsa": element(0x30, number(0), *(number(BIG + k) for k in range(8))),
    "dsa": element(0x30, number(0), *(number(BIG + k) for k in range(5))),
    "pkcs8": element(0x30, number(0), ALGORITHM, OCTETS),
    "pkcs8 with public": element(0x30, number(1), ALGORITHM, OCTETS, element(0xA1, BITS)),
    "encrypted": element(0x30, ALGORITHM, OCTETS),
    "sec1": element(0x30, number(1), OCTETS, element(0xA0, element(0x06, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")), element(0xA1, BITS)),
    "pkcs12": element(0x30, number(3), element(0x30, element(0x06, b"\x2a\x86\x48\x86\xf7\x0d\x01\x07\x01"), element(0xA0, OCTETS)), element(0x30, OCTETS)),
}
OTHER = {
    "certificate": element(0x30, element(0x30, element(0xA0, number(2)), number(BIG), ALGORITHM, ALGORITHM), ALGORITHM, BITS),
    "request": element(0x30, element(0x30, number(0), ALGORITHM), ALGORITHM, BITS),
    "public key": element(0x30, ALGORITHM, BITS),
    "rsa public": element(0x30, number(BIG), number(65537)),
    "signature": element(0x30, number(BIG), number(BIG + 2)),
    "two sequences": element(0x30, ALGORITHM, ALGORITHM, OCTETS),
    "wrong version": element(0x30, number(7), ALGORITHM, OCTETS),
    "no algorithm": element(0x30, number(0), element(0x30, number(5)), OCTETS),
}


@pytest.mark.parametrize("name", PRIVATE)
def test_private_keys_are_found(name):
    text = base64.b64encode(PRIVATE[name]).decode()
    assert [k for k, *_ in secrets.confirmed_spans(f"key: {text} .")] == ["der"]
    assert [k for k, *_ in secrets.confirmed_spans(f"key: {PRIVATE[name].hex()} .")] == ["der"]
    assert not secrets.is_der_key(PRIVATE[name][:-1]) and not secrets.is_der_key(PRIVATE[name] + b"\0")


@pytest.mark.parametrize("name", OTHER)
def test_what_is_public_is_no_secret(name):
    text = base64.b64encode(OTHER[name]).decode()
    assert not secrets.confirmed_spans(f"key: {text} .") and not secrets.confirmed_spans(OTHER[name].hex())
    assert secrets.redacted(f"x5c: {text} .") == f"x5c: {text} ."


def test_public_ssh_keys_are_listed_and_stay():
    blob = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", bytes(32)))
    text = "ssh-ed25519 " + base64.b64encode(blob).decode() + " me"
    assert [k for k, *_ in secrets.scan(text)[1]] == ["ssh_public"] and secrets.redacted(text) == text


def test_tokens_begin_where_their_alphabet_does():
    part = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'a': 1})}.c2ln"
    for before in ("", " ", '"', "=", "é", "."):
        assert ("jwt", len(before), len(before) + len(token)) in secrets.confirmed_spans(before + token)


@pytest.mark.parametrize("unit", ["eyJ", "eyJ.", "AAAA", "MIIE", "30", "-----BEGIN PRIVATE KEY-----", "token=", "AKIA", 'eyJ.x"'])
def test_a_megabyte_of_candidates_takes_seconds(unit):
    took = []
    for size in (250_000, 1_000_000):
        text = unit * (size // len(unit))
        start = time.process_time()
        secrets.scan(text)
        took.append(time.process_time() - start)
    assert took[1] < 20 and took[1] < 10 * took[0] + 1
