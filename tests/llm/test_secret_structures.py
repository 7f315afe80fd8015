"""Which structures are secrets, where they may stand, and how long the search takes."""

from __future__ import annotations

import base64
import random
import time

import pytest
from test_signed_tokens import TOKEN

from pulseframe.llm import secret_scan

RNG = random.Random(31)


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | (w := (n.bit_length() + 7) // 8)]) + n.to_bytes(w, "big")
    return bytes([tag]) + size + content


def number(n):
    return der(2, b"\1" + RNG.randbytes(n))


def fields(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


VERSION = der(2, b"\0")
RSA_ID = der(0x30, der(6, bytes.fromhex("2a864886f70d010101")) + der(5, b""))
RSA = der(0x30, VERSION + b"".join(number(n) for n in (128, 2, 128, 64, 64, 64, 64, 64)))
PRIVATE = {
    "rsa": RSA,
    "dsa": der(0x30, VERSION + b"".join(number(n) for n in (64, 20, 64, 64, 20))),
    "elliptic": der(0x30, der(2, b"\1") + der(4, RNG.randbytes(32)) + der(0xA0, der(6, b"\x2a\x86\x48"))),
    "wrapped": der(0x30, VERSION + RSA_ID + der(4, RSA)),
    "encrypted": der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, b"")) + der(4, RNG.randbytes(80))),
}
PUBLIC = {
    "numbers": der(0x30, number(128) + number(2)),
    "named": der(0x30, RSA_ID + der(3, b"\0" + der(0x30, number(128) + number(2)))),
    "certificate": der(0x30, der(0x30, number(8) + RSA_ID + der(0x30, number(16))) + RSA_ID + der(3, b"\0" + RNG.randbytes(128))),
    "digest": der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b"")) + der(4, RNG.randbytes(32))),
}
POINT = fields(b"ssh-" + b"ed25519", RNG.randbytes(32))
NAME = b"openssh-key-v1\0"
CONTAINER = NAME + fields(b"none", b"none", b"") + (1).to_bytes(4, "big") + fields(POINT, RNG.randbytes(96))


def b64(data):
    return base64.b64encode(data).decode()


def found(text, kinds=("der_key", "key_blob", "pem_key", "signed_token")):
    return [s for s in secret_scan.spans_of(text) if s[0] in kinds]


@pytest.mark.parametrize("name", PRIVATE)
@pytest.mark.parametrize("before", ["", "key=", "/etc/keys/", "a-b_", "\n"])
def test_private_keys(name, before):
    text = b64(PRIVATE[name])
    assert found(before + text + " end") == [("der_key", len(before), len(before) + len(text))]
    hexed = PRIVATE[name].hex()
    assert found(f"({hexed})") == [("der_key", 1, 1 + len(hexed))]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_key_over_lines_without_a_frame(end):
    letters = b64(RSA)
    text = end.join(letters[k : k + 64] for k in range(0, len(letters), 64))
    assert found(f"as follows\n{text}\nNext line") == [("der_key", 11, 11 + len(text))]


@pytest.mark.parametrize("name", PUBLIC)
def test_public_structures_are_no_secrets(name):
    assert found(b64(PUBLIC[name])) == [] and found(PUBLIC[name].hex()) == []


def test_containers():
    assert found("x/" + b64(CONTAINER)) == [("key_blob", 2, 2 + len(b64(CONTAINER)))]
    assert found(CONTAINER.hex()) == [("key_blob", 0, 2 * len(CONTAINER))]
    for broken in (NAME + b"x" * 40, CONTAINER[:-1], CONTAINER + b"\0", NAME + fields(b"none", b"none", b"") + (9).to_bytes(4, "big") + fields(POINT, b"x" * 96), NAME):
        assert found(b64(broken) + " " + broken.hex()) == []
    assert found(b64(POINT) + " me@host") == []


@pytest.mark.parametrize(
    "text",
    [
        "A" * 10_000_000,
        "M" * 10_000_000,
        "e-" * 5_000_000,
        "eyJ-" * 2_500_000,
        "/MIIB" * 400_000,
        "f" * 10_000_000,
        "." * 10_000_000,
        "a." * 5_000_000,
        b64(NAME) * 50_000,
    ],
    ids=["letters", "sequence", "dashes", "headers", "lengths", "hex", "stops", "words", "containers"],
)
def test_long_texts_in_linear_time(text):
    began = time.perf_counter()
    secret_scan.spans_of(f"www.example.com {TOKEN} {text}")
    took = time.perf_counter() - began
    assert took < 6
