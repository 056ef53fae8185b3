"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words whose smallest period is q, at least
``max(6, 4 q)`` words long, that no neighbouring word extends.

Periods up to ``SHORT`` are found by scanning a text against itself at each
lag.  Longer ones are found scale by scale: at the scale Q = 2, 4, 8 ... x
``SHORT``, for periods in (Q/2, Q], every window of Q/2 starts is represented
by the start of its least Q-gram.  Inside a run a window and the one q words
on hold the same grams, so their minimizers are q apart; and as a gram is no
shorter than the period, equal grams of a run stand at multiples of q only.
So neighbouring equal minimizers at a distance in (Q/2, Q] seed every run of
the scale.  Seeds are extended word by word both ways: a hash only proposes.
The work of a scale is linear in the words, and there are log(n) scales.

Texts are taken many at a time, one after another in one array, each closed by
a word of its own, the longest first, so that a scale reads the head of the
array that holds texts long enough for it.

Defined cases: a null text has no words; a text without a run keeps its words;
repeated rows give repeated results; an empty table gives an empty result;
all other columns stay as they are, the results' names given by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.tables import extended, no_text, unused

#: Characters that part words, beside the plain blank.
BLANKS = r"[\x09-\x0D]"

#: Periods found by direct lag scans; a power of two.
SHORT = 8
#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words analysed at a time (a longer text goes alone).
WORDS_AT_ONCE = 1 << 18

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _mixed(x: np.ndarray) -> np.ndarray:
    # a 64-bit finaliser; the constants are odd and otherwise arbitrary
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of grams of twice the width."""
    if len(h) <= width:
        return h[:0]
    return _mixed(h[:-width] * np.uint64(0xD6E8FEB86659FD93) + h[width:])


def _lag_stretches(words: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of stretches of at least ``least`` places that
    equal the place ``q`` on."""
    if len(words) <= q:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    same = np.zeros(len(words) - q + 2, "int8")
    same[1:-1] = words[:-q] == words[q:]
    edges = np.flatnonzero(np.diff(same))
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= least
    return starts[long], (stops - starts)[long]


def _reach(words: np.ndarray, at: int, lag: int) -> int:
    """Places from ``at`` on that equal the place ``lag`` on, in a row."""
    n, step, end = 0, 64, len(words) - lag
    while at + n < end:
        stop = min(at + n + step, end)
        differ = np.flatnonzero(words[at + n : stop] != words[at + n + lag : stop + lag])
        if len(differ):
            return n + int(differ[0])
        n, step = stop - at, step * 2
    return n


def _reach_back(words: np.ndarray, at: int, lag: int) -> int:
    """Places before ``at`` that equal the place ``lag`` on, in a row."""
    n, step = 0, 64
    while at - n > 0:
        start = max(at - n - step, 0)
        differ = np.flatnonzero(words[start : at - n] != words[start + lag : at - n + lag])
        if len(differ):
            return n + (at - n - start - 1 - int(differ[-1]))
        n, step = at - start, step * 2
    return n


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minimizers of the scale."""
    w = scale // 2
    if len(grams) < w:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype="uint64")
    width = 1
    while width < w:  # minima of windows of twice the width
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    at = (least & np.uint64(0xFFFFFFFF)).astype("int64")  # never falls from one window to the next
    at = at[np.r_[True, at[1:] != at[:-1]]]
    of = grams[at]
    order = np.argsort(of, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    near = (of[order[:-1]] == of[order[1:]]) & (b - a > w) & (b - a <= scale)
    a, b = a[near], b[near]
    first = np.argsort(a, kind="stable")
    return a[first], (b - a)[first]


def array_runs(words: np.ndarray, reach: list[int], longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in an array of word numbers.

    ``reach[i]`` is how much of the array has to be read for texts of at least
    2 ** i words, which come first; ``longest`` is the longest text.  Numbers
    that stand once (between texts) are in no run and end every run.
    """
    best: dict[tuple[int, int], int] = {}  # the smallest period of a stretch

    def found(start: int, length: int, q: int) -> None:
        # a stretch of four periods with a smaller period is that period's run too
        if length >= max(LEAST_WORDS, LEAST_PERIODS * q) and best.get((start, length), q) >= q:
            best[start, length] = q

    for q in range(1, min(SHORT, longest // LEAST_PERIODS) + 1):
        # a stretch over the end of a text is shorter than q
        for start, n in zip(*(x.tolist() for x in _lag_stretches(words, q, max(LEAST_WORDS, LEAST_PERIODS * q) - q))):
            found(start, n + q, q)
    scale = 2 * SHORT
    if longest >= LEAST_PERIODS * (SHORT + 1):
        grams, width = _mixed(words.astype("uint64") + np.uint64(1)), 1
        while width < SHORT:
            grams, width = _doubled(grams, width), width * 2
        while longest >= LEAST_PERIODS * (scale // 2 + 1):
            part = reach[(LEAST_PERIODS * (scale // 2 + 1)).bit_length() - 1]
            grams = _doubled(grams[: max(part - width + 1, 0)], width)
            width *= 2
            covered: dict[int, int] = {}
            for at, lag in zip(*(x.tolist() for x in _seeds(grams, scale))):
                if at < covered.get(lag, -1):
                    continue
                back, on = _reach_back(words, at, lag), _reach(words, at, lag)
                covered[lag] = at + on
                found(at - back, back + on + lag, lag)
            scale *= 2
    return [(start, length, q) for (start, length), q in best.items()]


def text_runs(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and sorted runs of each text, analysed together."""
    split = [t.split() for t in texts]  # at the six ASCII blanks
    order = sorted(range(len(split)), key=lambda i: -len(split[i]))
    ids: dict[bytes, int] = {}
    total = sum(map(len, split)) + len(split)
    words, starts, end = np.empty(total, "int64"), np.empty(len(split), "int64"), 0
    longest = len(split[order[0]]) if split else 0
    reach = [0] * (longest.bit_length() + 1)
    for rank, i in enumerate(order):
        own = split[i]
        starts[rank] = end
        words[end : end + len(own)] = [ids.setdefault(w, len(ids)) for w in own]
        end += len(own)
        words[end] = -1 - rank  # ends the text, equal to nothing
        end += 1
        for level in range(len(own).bit_length()):
            reach[level] = end
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, length, q in array_runs(words, reach, longest):
        rank = int(np.searchsorted(starts, start, "right")) - 1
        runs[order[rank]].append((start - int(starts[rank]), length, q))
    for own, mine in zip(split, runs):
        mine.sort(key=lambda r: (r[0], r[2]))
        yield own, mine


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, of every run its first period only."""
    if runs:
        edge = np.zeros(len(words) + 1, "int64")
        for start, length, q in runs:
            edge[start + q] += 1
            edge[start + length] -= 1
        keep = np.cumsum(edge[:-1]) == 0
        words = [w for w, k in zip(words, keep.tolist()) if k]
    return b" ".join(words)


def _groups(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Bounds of groups of about ``WORDS_AT_ONCE`` words, or of one text."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"") // 6 + 1
        if size and size + n > WORDS_AT_ONCE:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def with_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapse: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of its text, ordered by start and period (word
    numbers from 0), and the text with every run cut to its first period.

    Columns of ``docs`` called like the results give way to them.
    """
    base = docs.drop(*[c for c in docs.columns if c.lower() in (runs.lower(), collapse.lower()) and c != text])
    source = unused(base, "_text")[0]
    base = base.withColumn(source, no_text(text).cast("binary"))
    if text.lower() in (runs.lower(), collapse.lower()):
        base = base.drop(text)
    kept = [c for c in base.columns if c != source]
    schema = extended(base.select(*kept), {runs: RUNS, collapse: T.StringType()})

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(source))
            rest = batch.select(kept)
            sizes = texts.to_pylist()
            for a, b in _groups(sizes):
                found, left = [], []
                for words, mine in text_runs(sizes[a:b]):
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
                    left.append(collapsed(words, mine).decode())
                part = rest.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.list_(RUN)), pa.array(left, pa.string())], names=[*kept, runs, collapse]
                )

    return base.mapInArrow(analyse, schema)


def strongest(runs: str = "runs"):
    """The longest run (ties: smallest start, then period), null without one."""
    return F.aggregate(
        runs, F.lit(None).cast(RUNS.elementType), lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best)
    )
