"""Unigram encoding and decoding with a SentencePiece vocabulary.

A text becomes marker-escaped (a blank is the marker, one is put in front)
and is cut into the pieces of highest total log score: Viterbi over the
matches of a double-array trie of the pieces' UTF-8 bytes.  A character that
no piece covers costs a penalty below the lowest score and falls back to its
bytes.  Decoding turns markers to blanks and bytes to characters.

If no piece has the marker after another character (checked on loading),
no piece spans a word's start, so words are cut on their own and a worker
keeps the ids of short words it has seen in two generations, each bounded in
words and bytes, so frequent ones stay.  Long texts go in portions that end where
words do; the search over a word, however long, keeps a few numbers for each
of its bytes.  A marker character that the text itself holds is coded by its
bytes, so decoding gives every text back exactly.

The vocabulary's file is a parameter.  The trie is built from it once, on
the driver, and broadcast: its size is the vocabulary's.

Defined cases: a null or empty text has no pieces and decodes to the empty
text; repeated rows give repeated results; an empty table an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.tables import extended, unused

MARK = "▁"
MARK_BYTES = MARK.encode()
#: Words, and bytes, of a generation.
CACHE, CACHE_BYTES = 300_000, 48 << 20
#: Bytes that a kept word takes beside its characters and ids.
ENTRY = 200
#: Words of more characters are not kept.
CACHED_CHARS = 48
#: Characters of a text encoded, and ids decoded, at a time.
PORTION = 1 << 18
#: Bytes of ids that leave a worker at a time, about.
PORTION_BYTES = 4 << 20
#: Bytes of a word beyond which the search keeps its state in arrays.
LONG_WORD = 4096
NEVER = float("-inf")
#: What an uncovered character costs below the lowest score.
UNKNOWN_PENALTY = 10.0
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6


def double_array(keys: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """(base, check, value) of a trie: from state s byte c leads to
    t = base[s] + c + 1 if check[t] == s; value[t] is the key's number or -1.
    State 0 is the root."""
    children: list[dict[int, int]] = [{}]
    number = [-1]
    for key, v in keys.items():
        node = 0
        for c in key:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
                number.append(-1)
            node = nxt
        number[node] = v
    import numpy as np

    size = 4 * len(children) + 1024
    base, check, value = np.zeros(size, "int64"), np.full(size, -1, "int64"), np.full(size, -1, "int64")
    check[0] = 0
    begin: dict[int, int] = {}  # by number of labels: where the last place was
    window = 1 << 10
    todo = [(0, 0)]
    for node, state in todo:
        value[state] = number[node]
        labels = sorted(children[node])
        if not labels:
            base[state] = -(1 << 40)  # leads nowhere
            continue
        b = begin.get(len(labels), 0)
        while True:
            if b + window + 257 >= len(check):
                base, check, value = (np.r_[x, np.full(size, fill)] for x, fill in ((base, 0), (check, -1), (value, -1)))
            taken = np.zeros(window, bool)
            for c in labels:
                taken |= check[b + c + 1 : b + c + 1 + window] >= 0
            first = int(taken.argmin())
            if not taken[first]:
                b += first
                break
            b += window
        begin[len(labels)] = b  # near enough: an earlier gap may fit other labels, which only costs room
        base[state] = b
        at = b + np.array(labels) + 1
        check[at] = state
        todo += [(children[node][c], t) for c, t in zip(labels, at.tolist())]
    return base.tolist(), check.tolist(), value.tolist()


class Model:
    """The parts of a SentencePiece file that encoding and decoding need."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("byte fallback needs a piece for every byte")
        usable = {p.encode(): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t in (NORMAL, USER_DEFINED)}
        if any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in usable.values()):
            raise ValueError("a piece spans the start of a word")
        # a line break that is in no piece ends a unit too
        self.unit = " *[^ \n]+|\n| +" if not any("\n" in self.pieces[i] for i in usable.values()) else " *[^ ]+| +"
        self.unknown = min(s for s, t in zip(self.scores, self.types) if t == NORMAL) - UNKNOWN_PENALTY
        self.base, self.check, self.value = double_array(usable)


class Codec:
    def __init__(self, model: Model):
        self.m = model
        self.unit = re.compile(model.unit)
        self.start = re.compile("(?<=[^ ]) ")
        self.code = "H" if len(model.pieces) <= 1 << 16 else "I"
        self.dtype = "u2" if self.code == "H" else "u4"
        self.seen: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of seen
        self.raw = [
            bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode() if t in (NORMAL, USER_DEFINED, UNUSED) else b""
            for p, t in zip(model.pieces, model.types)
        ]

    def viterbi(self, data: bytes) -> array:
        """Ids of the best segmentation; of equal ones, the one whose last
        piece is longest, and so on from the end."""
        base, check, value, scores, unknown = self.m.base, self.m.check, self.m.value, self.m.scores, self.m.unknown
        n = len(data)
        best, start, piece = [NEVER], [0], [-1]
        if n > LONG_WORD:  # arrays are slower, but a few bytes an entry
            best, start, piece = array("d", best), array("i", start), array("i", piece)
        best, start, piece = best * (n + 1), start * (n + 1), piece * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            lead = data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, state, i, single = best[at], 0, at, False
            while i < n:
                t = base[state] + data[i] + 1
                if t < 0 or check[t] != state:
                    break
                state = t
                i += 1
                v = value[t]
                if v >= 0:
                    s = here + scores[v]
                    if s > best[i]:
                        best[i], start[i], piece[i] = s, at, v
                    single = single or i - at == width
            if not single:
                s, i = here + unknown, at + width
                if s > best[i]:
                    best[i], start[i], piece[i] = s, at, -1
            at += width
        out = array(self.code)
        while n:
            v, at = piece[n], start[n]
            if v >= 0:
                out.append(v)
            else:
                out.extend([self.m.byte_ids[b] for b in reversed(data[at:n])])
            n = at
        out.reverse()
        return out

    def _word(self, word: str) -> bytes:
        if MARK not in word:
            return self.viterbi(word.replace(" ", MARK).encode()).tobytes()
        own = array(self.code, [self.m.byte_ids[b] for b in MARK_BYTES]).tobytes()  # the text's own marker characters
        return own.join(self.viterbi(part.replace(" ", MARK).encode()).tobytes() for part in word.split(MARK))

    def _portions(self, text: str) -> Iterator[str]:
        """Portions that begin with a blank behind another character, where
        a unit begins too."""
        at = 0
        while len(text) - at > PORTION:
            cut = self.start.search(text, at + PORTION)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> bytes:
        """Ids as bytes of ``dtype``."""
        if not text:
            return b""
        return b"".join(map(self._encode, self._portions(" " + text)))

    def _encode(self, text: str) -> bytes:
        units = self.unit.findall(text)
        if len(self.seen) > CACHE or self.held > CACHE_BYTES:
            self.old, self.seen, self.held = self.seen, {}, 0
        seen, old = self.seen, self.old
        parts = list(map(seen.get, units))
        if None in parts:
            for i, p in enumerate(parts):
                if p is None:
                    w = units[i]
                    p = parts[i] = seen.get(w) or old.get(w) or self._word(w)
                    if len(w) <= CACHED_CHARS:
                        seen[w] = p
                        self.held += ENTRY + len(w) + len(p)
        return b"".join(parts)

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        import numpy as np

        get, ids = self.raw.__getitem__, np.asarray(ids, "int32")
        raw = b"".join(b"".join(map(get, ids[at : at + PORTION].tolist())) for at in range(0, len(ids), PORTION))
        return raw.decode("utf-8", "replace").removeprefix(" ")


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    key = shared._jbroadcast_id if hasattr(shared, "_jbroadcast_id") else id(shared.value)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value)
    return _codecs[key]


def load(spark: SparkSession, path: str):
    """The vocabulary and its trie, for all tasks."""
    return spark.sparkContext.broadcast(Model(path))


def encode(docs: DataFrame, shared, text: str = "text", out: str = "piece_ids") -> DataFrame:
    """``docs`` without ``text``, with ``out``: array<int>, last."""
    rest = [c for c in docs.columns if c != text and c.lower() != out.lower()]
    body = unused(docs, "_body")[0]
    given = docs.select(*rest, F.col(text).cast("binary").alias(body))
    schema = extended(given.select(*rest), {out: T.ArrayType(T.IntegerType())})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        codec = _codec(shared)
        for b in batches:
            coded = [codec.encode((x.as_py() or b"").decode("utf-8", "replace")) for x in b.column(b.num_columns - 1)]
            ids = np.frombuffer(b"".join(coded), codec.dtype).astype("int32")
            ends = np.cumsum([0, *map(len, coded)]) // np.dtype(codec.dtype).itemsize
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(ids))], names=[*rest, out]
            )

    return given.mapInArrow(work, schema)


def round_trip(docs: DataFrame, shared, text: str = "text", out: str = "piece_ids", exact: str = "exact", crc: str = "decoded_crc32") -> DataFrame:
    """``encode``, and in the same worker the ids are decoded again: ``exact``
    says whether that gives the text (empty for null), ``crc`` is the CRC-32
    of what it gives.  Columns called like the results give way to them."""
    rest = [c for c in docs.columns if c != text and c.lower() not in (out.lower(), exact.lower(), crc.lower())]
    body = unused(docs, "_body")[0]
    given = docs.select(*rest, F.col(text).cast("binary").alias(body))
    schema = extended(given.select(*rest), {out: T.ArrayType(T.IntegerType()), exact: T.BooleanType(), crc: T.LongType()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        codec = _codec(shared)
        size = np.dtype(codec.dtype).itemsize
        for b in batches:
            texts, first = b.column(b.num_columns - 1), 0
            while first < b.num_rows:  # a portion's ids at a time
                coded, same, crcs, held, at = [], [], [], 0, first
                while at < b.num_rows and held < PORTION_BYTES:
                    text_ = (texts[at].as_py() or b"").decode("utf-8", "replace")
                    ids = codec.encode(text_)
                    back = codec.decode(np.frombuffer(ids, codec.dtype))
                    coded.append(ids)
                    same.append(back == text_)
                    crcs.append(zlib.crc32(back.encode()))
                    held, at = held + len(ids), at + 1
                flat = np.frombuffer(b"".join(coded), codec.dtype).astype("int32")
                ends = np.cumsum([0, *map(len, coded)]) // size
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, at - first) for c in b.columns[:-1]],
                        pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(flat)), pa.array(same), pa.array(crcs, pa.int64()),
                    ],
                    names=[*rest, out, exact, crc],
                )
                first = at

    return given.mapInArrow(work, schema)


def decode(encoded: DataFrame, shared, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``, the text of ``ids``, last.  A column called
    like it gives way."""
    rest = [c for c in encoded.columns if c.lower() != out.lower()]
    place = rest.index(ids)
    schema = extended(encoded.select(*rest), {out: T.StringType()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            column = b.column(place)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [codec.decode(flat[s:e]) for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*rest, out])

    return encoded.select(*rest).mapInArrow(work, schema)
