"""Secret scanning with structural confirmation.

Base rules are three patterns: assignments, access-key ids and hex strings.
Beyond them, long base64 and hex runs are only candidates; one is reported
when it decodes to what it would have to be: a private key whose nested DER
lengths and fields add up, an OpenSSH key whose length-prefixed strings do,
or a signed token whose header is JSON that names an algorithm.  Keys may be
on several lines, in an armour or without, the line breaks plain or written
as escapes (\\n, \\r) as in JSON and source texts; without an armour the key's
own length says with which line it ends.

Defined cases: a null text is empty; repeated rows give repeated results; an
empty table gives an empty result.  A text is scanned whole, in one task, a
row at a time.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import unused

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "private_key", "ssh_key", "signed_token")

# ASCII: a case-folding long s or Kelvin sign is no letter of the names.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGNED = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----((?:[^-]|-(?!----))+)-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
#: Line breaks as JSON and source texts write them, headers of an armoured key.
ESCAPE = re.compile(r"\\+(?:[nrt]|(?=\s))")
HEADER = re.compile(r"^[\x20\t]*[A-Za-z][A-Za-z0-9-]*:.*$", re.M)
BODY = re.compile(r"[A-Za-z0-9+/=\s]+")
#: Runs on lines of their own, the breaks plain or written as escapes.
BREAK = r"[\x20\t]*(?:[\r\n]|\\+[nr])(?:\s|\\+[nrt])*"
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{{16,}}+(?:{BREAK}[A-Za-z0-9+/]++={{0,2}})+")
LINE = re.compile(r"(?:\\+[nrt])+|[A-Za-z0-9+/]+={0,2}")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")

OPENSSH = b"openssh-key-v1\0"


def _decoded(run: str) -> bytes | None:
    run = re.sub(r"\s", "", run).rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill data[at:end] exactly."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
        if at + n > end:
            return None
        out.append((tag, at, at + n))
        at += n
    return out


INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


#: How the identifiers of password-based encryption begin.
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def is_private_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or DSA in DER: one
    sequence, nested lengths exact."""
    outer = _der(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = _der(data, *outer[0][1:])
    if not parts:
        return False
    tags = [t for t, _, _ in parts]
    sizes = [e - s for _, s, e in parts]
    if tags == [SEQUENCE, OCTETS]:  # how it is encrypted, and the key
        algorithm = _der(data, *parts[0][1:])
        return bool(algorithm) and algorithm[0][0] == OID and data[algorithm[0][1] : algorithm[0][2]].startswith(PASSWORD_BASED) and sizes[1] >= 16
    if tags[0] != INTEGER or sizes[0] != 1:
        return False
    if tags == [INTEGER] * 6:  # version, p, q, g, public and private key
        p, q = sizes[1:3]
        return data[parts[0][1]] == 0 and p >= 64 and 20 <= q <= 33 and max(sizes[3:5]) <= p + 1 and sizes[5] <= q + 1
    if tags[:9] == [INTEGER] * 9:  # version, n, e, d, p, q and three more
        return True
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = _der(data, *parts[1][1:])
        return bool(algorithm) and algorithm[0][0] == OID
    if tags[:2] == [INTEGER, OCTETS] and data[parts[0][1]] == 1:
        return parts[1][2] - parts[1][1] in (20, 24, 28, 32, 48, 66)
    return False


def _strings(data: bytes, at: int, count: int) -> int | None:
    """Where ``count`` length-prefixed strings from ``at`` end."""
    for _ in range(count):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return None
    return at


def is_ssh_key(data: bytes) -> bool:
    """OpenSSH's own private format: cipher, kdf, options, a number of keys,
    the public keys and the private block, to the last byte."""
    if not data.startswith(OPENSSH):
        return False
    at = _strings(data, len(OPENSSH), 3)
    if at is None or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    return 1 <= keys <= 16 and _strings(data, at + 4, keys + 1) == len(data)


def is_signed_token(run: str) -> bool:
    head, body, signature = run.split(".")
    try:
        header, claims = json.loads(_decoded(head) or b""), json.loads(_decoded(body) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str) or not isinstance(claims, dict):
        return False
    return bool(signature) and _decoded(signature) is not None or header["alg"].lower() == "none"


def _confirmed(data: bytes | None) -> str | None:
    if not data:
        return None
    return "private_key" if is_private_key(data) else "ssh_key" if is_ssh_key(data) else None


def _armoured(body: str) -> bytes | None:
    """What an armour holds, without its headers and written line breaks."""
    body = HEADER.sub("", ESCAPE.sub("\n", body).replace("\\/", "/"))
    return _decoded(body) if BODY.fullmatch(body) else None


def _length(run: str) -> int | None:
    """Bytes of the key that begins with ``run``, by its own lengths; None
    if none does."""
    head = _decoded(run[:32]) or b""
    if head[:1] == b"\x30" and len(head) > 8:
        k = head[1] & 0x7F if head[1] & 0x80 else 0
        n = int.from_bytes(head[2 : 2 + k], "big") if k else head[1]
        return 2 + k + n if k <= 4 and (head[2 + k : 4 + k] == b"\x02\x01" or head[2 + k] == SEQUENCE) else None
    if not head.startswith(OPENSSH):
        return None
    data = _decoded(run[: len(run) // 4 * 4]) or b""
    at = _strings(data, len(OPENSSH), 3)
    if at is None or at + 4 > len(data) or not 1 <= (keys := int.from_bytes(data[at : at + 4], "big")) <= 16:
        return None
    return _strings(data, at + 4, keys + 1)


def _wrapped(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of keys on several lines without an armour.  A key
    begins with a line and ends with one, where its own length says."""
    for m in WRAPPED.finditer(text):
        start = m.start()
        # the letter of an escape before the first run isn't part of it
        if start and text[start - 1] == "\\" and text[start] in "nrt":
            start += 1
        lines = [x.span() for x in LINE.finditer(text, start, m.end()) if text[x.start()] != "\\"]
        joined, at = "".join(text[s:e] for s, e in lines), [0]
        for s, e in lines:
            at.append(at[-1] + e - s)
        ends, after = {x: i for i, x in enumerate(at)}, 0
        for i, (s, _) in enumerate(lines):
            if i < after or not (text[s] == "M" or text.startswith("b3Bl", s)):
                continue
            n = _length(joined[at[i] :] if text[s] == "b" else joined[at[i] : at[i] + 32])
            if n is None:
                continue
            bare = at[i] + (4 * n + 2) // 3
            last = next((ends[x] for x in (bare + -n % 3, bare) if x in ends), None)
            if last is not None and last > i + 1 and (k := _confirmed(_decoded(joined[at[i] : at[last]]))):
                yield s, k, lines[last - 1][1]
                after = last


def scan(text: str, data: bytes | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans) as (start, index in KINDS, end), sorted."""
    low = (text.encode() if data is None else data).lower()
    base, added = [], []
    if any(w in low for w in ASSIGN_WORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "eyJ" in text:
        added += [(m.start(), 5, m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    if "-----BEGIN " in text:
        added += [(m.start(), KINDS.index(k), m.end()) for m in ARMOUR.finditer(text) if (k := _confirmed(_armoured(m[1])))]
    armoured = [(s, e) for s, _, e in added]
    # a DER sequence starts with 0x30 0x8? or a short length, OpenSSH's with its magic: M or b3Bl
    for m in BASE64.finditer(text):
        # the letter of an escape before the run isn't part of it
        at = m.start() + (m.start() > 0 and text[m.start() - 1] == "\\" and m[0][0] in "nrt")
        run = text[at : m.end()]
        if (run.startswith(("M", "b3Bl"))) and (k := _confirmed(_decoded(run))):
            if not any(s <= at and m.end() <= e for s, e in armoured):
                added.append((at, KINDS.index(k), m.end()))
    added += [(s, KINDS.index(k), e) for s, k, e in _wrapped(text) if not any(a <= s and e <= z for a, z in armoured)]
    for m in HEX_KEY.finditer(text):
        if m[0][:2] in ("30", "6f", "6F") and len(m[0]) % 2 == 0 and (k := _confirmed(bytes.fromhex(m[0]))):
            added.append((m.start(), KINDS.index(k), m.end()))
    return sorted(base), sorted(added)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs``, and ``secret_base`` and
    ``secret_spans``: arrays of (s, k, e), k an index in ``KINDS``.  Columns
    of ``docs`` called like these give way to them."""
    rest = [c for c in docs.columns if c != text and c.lower() not in ("secret_base", "secret_spans")]
    span = "array<struct<s:int,k:int,e:int>>"
    given = docs.select(*rest, F.col(text).cast("binary").alias(unused(docs, "secret_body")[0]))
    schema = given.select(*rest, F.lit(None).cast(span).alias("secret_base"), F.lit(None).cast(span).alias("secret_spans")).schema
    kind = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bases, every = [], []
            for x in b.column(b.num_columns - 1):
                data = x.as_py() or b""
                base, added = scan(data.decode("utf-8", "replace"), data)
                bases.append([{"s": s, "k": k, "e": e} for s, k, e in base])
                every.append([{"s": s, "k": k, "e": e} for s, k, e in sorted(base + added)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(bases, kind), pa.array(every, kind)], names=[*rest, "secret_base", "secret_spans"]
            )

    return given.mapInArrow(work, schema)
