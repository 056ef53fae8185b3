"""Static range asymmetric numeral system over token ids, in numpy.

``lanes`` interleaved 64-bit states share one stream of 32-bit words; symbol
i belongs to lane i % lanes at step i // lanes.  The frequency table is
shared by all blocks of a file set.  A block can be decoded from its start
or from any of its checkpoints (states and word offset before a step), and
its words carry a CRC-32.
"""

from __future__ import annotations

import struct
import zlib

PROB_BITS = 20
LOW = 1 << 31
LANES = 512
CHECKPOINT_STEPS = 256
MAGIC = b"TRNS"
HEAD = struct.Struct("<4sIIIII")  # magic, ids, lanes, checkpoints, words, crc32 of what follows


def quantised(counts, bits: int = PROB_BITS):
    """Frequencies that sum to 2^bits, at least 1 for every id seen."""
    import numpy as np

    counts = np.asarray(counts, "float64")
    seen = np.flatnonzero(counts)
    if len(seen) > 1 << bits:
        raise ValueError(f"more than 2^{bits} different ids")
    freqs = np.zeros(len(counts), "int64")
    if len(seen):
        freqs[seen] = np.maximum(1, np.floor(counts[seen] / counts.sum() * (1 << bits)))
        spare = (1 << bits) - int(freqs.sum())
        order = seen[np.argsort(-counts[seen], kind="stable")]
        if spare >= 0:
            freqs[order[0]] += spare
        else:
            for i in order:  # the most frequent give back what the rarest got
                take = min(-spare, int(freqs[i]) // 2)
                freqs[i] -= take
                spare += take
                if not spare:
                    break
    return freqs


class Coder:
    def __init__(self, freqs, bits: int = PROB_BITS):
        import numpy as np

        self.bits = bits
        self.freqs = np.asarray(freqs, "uint64")
        self.starts = np.cumsum(self.freqs) - self.freqs
        self._symbols = None

    def encode(self, ids, lanes: int = LANES) -> bytes:
        import numpy as np

        n = len(ids)
        lanes = max(1, min(lanes, n // 64 or 1))
        steps = -(-n // lanes)
        f_all, c_all = self.freqs[ids], self.starts[ids]
        if n and not f_all.all():
            raise ValueError("an id that the frequency table doesn't have")
        x = np.full(lanes, LOW, "uint64")
        words, marks = [], []
        shift, up, bits = np.uint64(63 - self.bits), np.uint64(32), np.uint64(self.bits)
        for t in range(steps - 1, -1, -1):
            f, c = f_all[t * lanes : (t + 1) * lanes], c_all[t * lanes : (t + 1) * lanes]
            y = x[: len(f)]
            full = y >= f << shift
            out = y[full]
            words.append(out.astype("<u4"))  # its low half
            y[full] = out >> up
            q = y // f
            x[: len(f)] = (q << bits) + (y - q * f) + c
            if t and t % CHECKPOINT_STEPS == 0:
                marks.append((t, x.copy()))
        words.reverse()
        offsets = np.cumsum([0, *map(len, words)])
        body = x.astype("<u8").tobytes()
        for t, states in reversed(marks):
            body += struct.pack("<II", t, int(offsets[t])) + states.astype("<u8").tobytes()
        body += b"".join(w.tobytes() for w in words)
        return HEAD.pack(MAGIC, n, lanes, len(marks), int(offsets[-1]), zlib.crc32(body)) + body

    def decode(self, block: bytes, checkpoint: int = 0, until: int | None = None):
        """The ids from a checkpoint (0: the start) up to, but without, the
        checkpoint ``until`` (none: the end)."""
        import numpy as np

        magic, n, lanes, marks, n_words, crc = HEAD.unpack_from(block)
        body = memoryview(block)[HEAD.size :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freqs), dtype="uint32"), self.freqs.astype("int64"))
        states_at, at, t = 0, 0, 0
        size = 8 + 8 * lanes
        mark = lambda k: struct.unpack_from("<II", body, 8 * lanes + (k - 1) * size)
        if checkpoint:
            t, at = mark(checkpoint)
            states_at = 8 * lanes + (checkpoint - 1) * size + 8
        x = np.frombuffer(body, "<u8", lanes, states_at).astype("uint64")
        words = np.frombuffer(body, "<u4", n_words, 8 * lanes + marks * size)
        end = mark(until)[0] if until and until <= marks else -(-n // lanes)
        first = t * lanes
        out = np.empty(max(0, min(n, end * lanes) - first), "uint32")
        mask, bits, up = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(32)
        while t < end:
            k = min(lanes, n - t * lanes)
            y = x[:k]
            slot = y & mask
            s = self._symbols[slot]
            out[t * lanes - first : t * lanes - first + k] = s
            y = self.freqs[s] * (y >> bits) + slot - self.starts[s]
            low = np.flatnonzero(y < LOW)
            y[low] = (y[low] << up) | words[at : at + len(low)]
            at += len(low)
            x[:k] = y
            t += 1
        return out
