"""Byte-level BPE encoding with the tokenizers library, cached by unit.

A byte-level tokenizer never merges across the borders of its pre-tokens, so
texts are cut at some of these borders into units that can be encoded on
their own: all texts of a portion at once, by the kinds of a character and
its two neighbours.  Each different unit of a portion is looked up once.  A
worker keeps the ids of units it has seen -- two generations of at most
``CACHE`` each, so frequent ones stay -- and hands the library only new
ones: those that are one pre-token straight to the library's model, the
others as texts.  Texts that hold one of the vocabulary's added tokens, and
vocabularies of any other make, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

CACHE = 250_000
#: New words whose tokens are held at a time.
WORDS = 4096
#: Characters whose borders are found at a time.
BLOCK = 1 << 16
#: Unicode white space, as the tokenizer's own pattern understands it.
BLANK = "\t-\r \x85\xa0  -     　"
#: Letters by any version of Unicode.
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
SIGN = r"!-&(-/:-@\[-`{-~"
#: The cuts as a pattern, which the tests hold ``borders`` against: it has these
#: and some more, but none beside control characters, which are unknown there.
#: A pre-token ends where these letters, ASCII digits and signs meet, too -- but
#: for an apostrophe, which may begin a contraction, and beside other characters,
#: whose class isn't known here: such a run is one unit up to its blank.
UNIT = re.compile(
    f" ?(?:[{LETTER}]++(?=[\x00-\x7f]|\\Z)|[0-9]++(?=[\x00-\x7f{LETTER}]|\\Z)|[{SIGN}]++(?=[\x00-\x26\x28-\x7f{LETTER}]|\\Z)"
    f"|[^{BLANK}]+)|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
#: A unit that is one pre-token.
SINGLE = re.compile(f" ?(?:[{LETTER}]+|[0-9]+|[{SIGN}]+)")

#: Kinds of characters: letters, digits, signs, apostrophe, unknown, space,
#: other blanks, and what is beside a text.
L, D, S, A, U, SPACE, W, END = range(8)


def kinds():
    """The kind of each code point."""
    import numpy as np

    out = np.full(0x110000, U, "uint8")
    known = "".join(map(chr, range(ord(BLANK[-1]) + 1)))
    for kind, characters in ((W, BLANK), (L, LETTER), (D, "0-9"), (S, SIGN)):
        out[[m.start() for m in re.finditer(f"[{characters}]", known)]] = kind
    out[[ord("'"), ord(" ")]] = A, SPACE
    return out


def borders():
    """Whether a unit begins at a character, at 64 * the kind of the one
    before + 8 * its own + the kind of the next one.  Characters of two kinds
    are one pre-token only as a space and what follows it, or as an apostrophe
    and letters; a run of blanks leaves its last one to what follows it."""
    import numpy as np

    out = np.zeros((8, 8, 8), bool)
    blank, word = (SPACE, W), (L, D, S, A, U)
    for before in range(8):
        for own in range(8):
            if before in blank and own in blank:
                out[before, own, list(word)] = True
            elif before in blank:
                out[before, own] = before == W
            elif own in blank or before == END:
                out[before, own] = True
            else:
                out[before, own] = before != own and U not in (before, own) and (before, own) not in ((A, L), (A, S), (S, A))
    return out.reshape(-1)


def byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_unit = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        )
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.vocab = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.vocab <= 1 << 16 else "<u4"
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        if self.by_unit:
            # the model without the pre-tokenizer and the added tokens, neither of which single pre-tokens need
            self.model = self.lib.model
            self.shown = [(chr(b), c) for b, c in byte_characters().items() if b != 0x0A and chr(b) != c]
            self.kinds, self.borders = kinds(), borders()

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, self.dtype).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _single_ids(self, units: list[str]) -> list[bytes]:
        """Ids of units that are one pre-token each, which hold no line break:
        their bytes' characters go to the model."""
        import numpy as np

        words = "\n".join(units).encode().decode("latin-1")
        for b, c in self.shown:
            words = words.replace(b, c)
        words, out = words.split("\n"), []
        for i in range(0, len(words), WORDS):
            tokens = list(map(self.model.tokenize, words[i : i + WORDS]))
            ids = np.array([t.id for w in tokens for t in w], self.dtype)
            cuts = (np.cumsum(list(map(len, tokens))) * ids.itemsize).tolist()
            ids = ids.tobytes()
            out += [ids[s:e] for s, e in zip([0, *cuts], cuts)]
        return out

    def _learn(self, new: set[str]) -> None:
        older = self.older
        known = [u for u in new if u in older]
        self.seen.update(zip(known, map(older.__getitem__, known)))
        new.difference_update(known)
        single = list(filter(SINGLE.fullmatch, new))
        self.seen.update(zip(single, self._single_ids(single) if single else ()))
        alone = list(new.difference(single))
        self.seen.update(zip(alone, self._ids(alone)))

    def units(self, texts: list[str]):
        """The units of all texts as an Arrow array, and how many there are up
        to the end of each text."""
        import numpy as np
        import pyarrow as pa

        joined = "".join(texts)
        body, n = joined.encode(), len(joined)
        kind, begins = np.full(n + 2, END, "uint8"), np.empty(n, bool)
        for s in range(0, n, BLOCK):
            chars = np.frombuffer(joined[s : s + BLOCK].encode("utf-32-le"), "<u4")
            kind[s + 1 : s + 1 + len(chars)] = self.kinds[chars]
        for s in range(0, n, BLOCK):
            near = kind[s : s + BLOCK + 2]
            begins[s : s + BLOCK] = self.borders[near[:-2].astype("uint16") << 6 | near[1:-1] << 3 | near[2:]]
        ends = np.cumsum(np.fromiter(map(len, texts), "int64", len(texts)))
        last = ends[np.diff(ends, prepend=0) > 0] - 1
        begins[last] = self.borders[kind[last].astype("uint16") << 6 | kind[last + 1] << 3 | END]
        begins[last[:-1] + 1] = True  # the next text
        at = np.flatnonzero(begins)
        upto = np.searchsorted(at, ends)
        if len(body) > n:  # from characters to bytes
            first = np.zeros(len(body), bool)
            first[np.frombuffer(body, "uint8") & 0xC0 != 0x80] = begins
            at = np.flatnonzero(first)
        offsets = pa.py_buffer(np.append(at, len(body)))
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, offsets, pa.py_buffer(body)]), upto

    def encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        import pyarrow as pa

        whole = [i for i, t in enumerate(texts) if not self.by_unit or any(a in t for a in self.added)]
        out = [b""] * len(texts)
        if len(whole) < len(texts):
            cut = texts.copy()
            for i in whole:
                cut[i] = ""
            units, upto = self.units(cut)
            units = units.dictionary_encode()
            if len(self.seen) > CACHE:
                self.seen, self.older = {}, self.seen  # a new generation
            different = units.dictionary.to_numpy(zero_copy_only=False).tolist()
            self._learn(set(different).difference(self.seen))
            ids = pa.array(list(map(self.seen.__getitem__, different)), pa.large_binary()).take(units.indices)
            if len(ids):
                ends = np.frombuffer(ids.buffers()[1], "int64")[upto].tolist()
                ids = memoryview(ids.buffers()[2])
                out = [bytes(ids[s:e]) for s, e in zip([0, *ends], ends)]
        for i in whole:
            out[i] = self._ids([texts[i]])[0]
        return out


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def in_portions(column, size: int = 4 << 20):
    """(texts, first row) portions of an Arrow binary column, about ``size``
    bytes each; null is an empty text."""
    texts, first, held = [], 0, 0
    for i, x in enumerate(column):
        t = x.as_py() or b""
        texts.append(t.decode("utf-8", "replace"))
        held += len(t)
        if held >= size:
            yield texts, first
            texts, first, held = [], i + 1, 0
    if texts:
        yield texts, first
