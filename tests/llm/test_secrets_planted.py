"""Confirmed secrets against keys planted in random texts, among decoys."""

import base64
import json
import random
import re

import pytest

from tillroll.llm import secrets


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (len(b := n.to_bytes((n.bit_length() + 7) // 8, "big")))]) + b
    return bytes([tag]) + size + body


def integer(rng, n):
    return der(2, bytes([rng.randrange(1, 128)]) + rng.randbytes(n - 1))


def keys(rng):
    """(kind, data) of a key in each structure."""
    version = der(2, b"\0")
    pbe = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, rng.randbytes(9)))
    rsa = der(0x30, version + b"".join(integer(rng, n) for n in (64, 3, 64, 32, 32, 32, 32, 32)))
    yield "private_key", rsa
    yield "private_key", der(0x30, version + der(0x30, der(6, b"\x2a\x86\x48") + b"\x05\0") + der(4, rsa))
    yield "private_key", der(0x30, pbe + der(4, rng.randbytes(rng.randrange(48, 200))))
    yield "private_key", der(0x30, version + b"".join(integer(rng, n) for n in (128, 20, 128, 128, 20)))
    yield "private_key", der(0x30, der(2, b"\1") + der(4, rng.randbytes(32)) + der(0xA0, der(6, b"\x2a\x86")))
    string = lambda x: len(x).to_bytes(4, "big") + x
    yield "ssh_key", secrets.OPENSSH + b"".join(map(string, (b"none", b"none", b""))) + (1).to_bytes(4, "big") + string(rng.randbytes(51)) + string(rng.randbytes(130))


def b64(data):
    return base64.b64encode(data).decode()


def written(rng, kind, data):
    """A key as a text may hold it, and where it stands in that."""
    way = rng.choice(["run", "hex", "armour", "escaped", "lines"])
    if way == "hex":
        return data.hex(), 0, 2 * len(data)
    body = b64(data)
    if way == "run":
        return body, 0, len(body)
    rows = re.findall(".{1,64}", body)
    if way == "lines" and len(rows) > 1:
        text = "\n".join(rows)
        return f"\n{text}\n", 1, 1 + len(text)
    text = ("\\n" if way == "escaped" else "\n").join(["-----BEGIN PRIVATE KEY-----", *rows, "-----END PRIVATE KEY-----"])
    return text, 0, len(text)


def decoy(rng):
    kind, data = rng.choice(list(keys(rng)))
    cut = rng.choice([
        lambda: data[: rng.randrange(len(data) // 2, len(data) - 3)], lambda: data[:1] + bytes([data[1] ^ 3]) + data[2:] if kind == "private_key" else data + b"more",
        lambda: rng.randbytes(90), lambda: der(0x30, der(2, b"\0") + integer(rng, 40) + der(5, b"")), lambda: der(0x30, der(0x30, der(6, b"\x2a\x86\x48")) + der(4, rng.randbytes(64))),
    ])()
    return b64(cut)


@pytest.mark.parametrize("seed", range(5))
def test_planted_keys_are_found_and_nothing_else(seed):
    rng = random.Random(seed)
    for _ in range(40):
        text, want = "", []
        for _ in range(rng.randrange(1, 6)):
            text += " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(rng.randrange(1, 8))) + " . "
            if rng.random() < 0.4:
                text += decoy(rng) + " "
                continue
            kind, data = rng.choice(list(keys(rng)))
            piece, s, e = written(rng, kind, data)
            want.append((len(text) + s, secrets.KINDS.index(kind), len(text) + e))
            text += piece + " "
        got = secrets.scan(text)[1]
        assert got == sorted(want), (text, got, want)


@pytest.mark.parametrize("seed", range(3))
def test_structures(seed):
    rng = random.Random(seed)
    for kind, data in keys(rng):
        assert secrets._confirmed(data) == kind
        for at in (len(data) - 1, len(data) // 2):
            assert secrets._confirmed(data[:at]) is None
        assert secrets._confirmed(data + b"\0") is None


def test_clashing_columns(spark):
    token = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"a": 1})) + ".c2lnbmF0dXJl"
    rows = [(1, f"x {token}", "b", 5, "s"), (2, None, None, None, None), (2, "", "b", 5, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, secret_body string, Secret_Base int, secret_spans string")
    got = secrets.find_secrets(df)
    assert got.columns == ["doc_id", "secret_body", "secret_base", "secret_spans"]
    found = sorted((r.doc_id, r.secret_body or "", [tuple(x) for x in r.secret_spans]) for r in got.collect())
    assert found == [(1, "b", [(2, 5, 2 + len(token))]), (2, "", []), (2, "b", [])]
