"""Chat formatting by prefix-target expansion.

A turn is written between marks of its role, control strings inside a text
are broken up reversibly, and every assistant turn becomes an example of its
own: all turns before it are its context and only its reply is trainable.

An example's context is a prefix of its conversation, so the formatted
conversation is stored once, a segment for each turn with its place, and the
examples as spans over it: (end of context, reply span, end).  Written out,
the contexts of a conversation of n turns would take n^2/2 turns;
``expanded`` does that where it is wanted, ``pieces`` a turn at a time.

Turns are placed by ranges of (conversation, turn): a conversation holding
most rows is spread over tasks, which number their own turns.

Defined cases: null texts and roles are empty; a null conversation is one
conversation; turns of the same number go by role, then text; repeated rows
are repeated turns; an empty table gives empty results; ids and turn numbers
count as longs, and such as don't are an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import no_text, numbered

#: Marks of known roles; others are named in their opening mark.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/TURN]")
CONTROL = r"<</?SYS>>|\[/?INST\]|</?s>|\[/?ROLE\]|\[/TURN\]"
ROLE = "assistant"


def escaped(text: Column) -> Column:
    """A backslash is doubled; a control string gets one after its first
    character.  So no control string is left, and a single backslash always
    marks a broken one."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"(?=(?:{CONTROL}))(.)", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def segments(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, segment, at, reply_start, reply_end): the formatted
    turns; ``at`` counts the characters before a turn in its conversation,
    the reply span (assistant turns only) is within the conversation."""
    r, t = no_text(role), escaped(no_text(text))
    opened = F.concat(F.lit(OTHER[0]), escaped(r), F.lit(OTHER[1]))
    closed = F.lit(OTHER[2])
    for name, (a, b) in MARKS.items():
        opened = F.when(r == name, a).otherwise(opened)
        closed = F.when(r == name, b).otherwise(closed)
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), r.alias("role"),
        no_text(text).alias("text"), F.concat(opened, t, closed).alias("segment"),
    ).withColumn("chars", F.length("segment").cast("long"))
    placed = numbered(rows, ["conv_id", "turn", "role", "text"], "at", per="conv_id", add="chars")
    mine = F.col("role") == ROLE
    a, b = (len(m) for m in MARKS[ROLE])
    return placed.select(
        "conv_id", "turn", "segment", "at",
        F.when(mine, F.col("at") + a).alias("reply_start"), F.when(mine, F.col("at") + F.col("chars") - b).alias("reply_end"),
    )


def examples(formatted: DataFrame) -> DataFrame:
    """An example for each assistant turn: characters of context, the span
    under the loss mask, and the example's length -- all counted in the
    conversation's formatted text."""
    return formatted.where("reply_start is not null").select(
        "conv_id", F.col("turn").alias("target_turn"), F.col("at").alias("context_chars"), "reply_start", "reply_end",
        (F.col("at") + F.length("segment")).alias("chars"),
    )


def expanded(formatted: DataFrame) -> DataFrame:
    """Examples as texts of their own.  For conversations of ordinary length:
    an example's turns are gathered in one row (``pieces`` gathers nothing)."""
    ex = examples(formatted).alias("e")
    before = formatted.select("conv_id", "at", "segment").alias("s")
    joined = ex.join(before, F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("s.at") <= F.col("e.context_chars")))
    return joined.groupBy("e.conv_id", "target_turn", "context_chars", "reply_start", "reply_end").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s.at", "s.segment"))), lambda x: x["segment"]), "").alias("text")
    )


def pieces(formatted: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The examples written out, each as ordered pieces of a turn each:
    (conv_id, target_turn, target_at, at, segment, trained).  An example's text
    is its segments in the order of ``at``; only the last, its reply, is
    trained.  Nothing is gathered in a row.

    An example has all turns before it, so a conversation of n turns gives up
    to n^2/2 pieces: ``targets`` (rows of ``examples``) chooses which examples
    are written out; by default all are."""
    chosen = (examples(formatted) if targets is None else targets).select(
        F.col("conv_id").alias("_conv"), "target_turn", F.col("context_chars").alias("target_at")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("at") <= F.col("target_at"))
    joined = chosen.join(formatted.select("conv_id", "at", "segment"), same)
    return joined.select("conv_id", "target_turn", "target_at", "at", "segment", (F.col("at") == F.col("target_at")).alias("trained"))


def parsed(formatted: DataFrame) -> DataFrame:
    """Role and text of each segment, read back from its marks."""
    seg = F.col("segment")
    inner = lambda a, b: F.substring(seg, F.lit(a + 1), F.length(seg) - (a + b))
    pattern = r"(?s)^\[ROLE\](.*?)\[/ROLE\](.*)\[/TURN\]$"
    role, text = F.regexp_extract(seg, pattern, 1), F.regexp_extract(seg, pattern, 2)
    for name, (a, b) in MARKS.items():
        role = F.when(F.startswith(seg, F.lit(a)), name).otherwise(role)
        text = F.when(F.startswith(seg, F.lit(a)), inner(len(a), len(b))).otherwise(text)
    return formatted.select("conv_id", "at", unescaped(role).alias("role"), unescaped(text).alias("text"), "segment", "reply_start", "reply_end")


PIECE = "conv_id long, at long, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Per conversation, read back from the formatted segments: turns, their
    SHA-256, and the characters and SHA-256 of what is under the loss mask:
    the reply spans of ``targets`` (by default the ``examples``), cut out of
    the segments.  An example whose context isn't the sum of the segments
    before it, or whose spans leave its segment, is an error.

    A digest runs over a conversation in order.  Tasks hold ranges of
    (conversation, place) and hand on their conversations' bytes in pieces of
    about a megabyte; the pieces of a conversation then stream by in order,
    so no conversation is ever held whole.  An example comes right after the
    segment at which its context ends."""
    targets = examples(formatted) if targets is None else targets
    body = F.concat("role", F.lit("\n"), "text", F.lit("\n")).cast("binary").alias("body")
    none = F.lit(None).cast("long")
    turns = parsed(formatted).select("conv_id", "at", body, "segment", none.alias("a"), none.alias("b"), F.length("segment").cast("long").alias("chars"))
    spans = targets.select(
        "conv_id", F.col("context_chars").alias("at"), F.lit(None).cast("binary").alias("body"), F.lit(None).cast("string").alias("segment"),
        F.col("reply_start").alias("a"), F.col("reply_end").alias("b"), "chars",
    )
    order = ["conv_id", "at", F.col("a").isNotNull()]
    ranged = turns.unionByName(spans).repartitionByRange("conv_id", "at").sortWithinPartitions(*order)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        size = 0

        def batch():
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            cols[3], cols[5] = [b"".join(x) for x in cols[3]], [b"".join(x) for x in cols[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv_id", "at", "n_turns", "turns", "loss_chars", "loss", "formatted_chars"])

        last = None
        for b in batches:
            for conv, at, body, segment, first, end, chars in zip(*(b.column(i).to_pylist() for i in range(7))):
                if body is None:  # an example of the segment just seen
                    if last is None or last[:2] != (conv, at) or not at <= first <= end <= chars or chars != at + len(last[2]):
                        raise ValueError(f"example {at}:{first}:{end}:{chars} of conversation {conv} doesn't fit its segments")
                    reply = re.sub(r"\\(\\?)", r"\1", last[2][first - at : end - at])
                    out[-1][4] += len(reply)
                    out[-1][5].append(reply.encode())
                    continue
                last = conv, at, segment
                # with the segment's example still to come, batches end before a segment
                if size > 1 << 20:
                    yield batch()
                    out, size = [], 0
                if not out or out[-1][0] != conv:
                    out.append([conv, at, 0, [], 0, [], 0])
                x = out[-1]
                x[2] += 1
                x[3].append(body)
                x[6] += chars
                size += len(body)
        if out:
            yield batch()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        now, done = None, []

        def batch():
            cols = list(zip(*[(x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5]) for x in done])) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for conv, at, n, turns, lc, loss, chars in zip(*(b.column(i).to_pylist() for i in range(7))):
                if now is None or now[0] != conv:
                    if now:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if at != now[5]:
                    raise ValueError(f"conversation {conv}: {now[5]} characters stand before {at}")
                now[1] += n
                now[2].update(turns)
                now[3] += lc
                now[4].update(loss)
                now[5] += chars
            yield batch()
            done = []
        if now:
            done = [now]
            yield batch()

    pieces = ranged.mapInArrow(gather, PIECE)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(fold, DIGEST)
