"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint takes, bit by bit, the majority of its word shingles'
64-bit hashes.  Fingerprints within ``RADIUS`` bits are linked and linked
documents form components.

Search: bit position i gets the (radius+1)-bit vector phi(i); for each of
the 2^(radius+1)-1 vectors v, table v keeps the bits with <phi(i), v> odd.
The vectors of at most ``radius`` differing bits span less than the whole
space, so some v is orthogonal to all of them: every pair within the radius
agrees on that table's mask.  No pair is lost, whatever the data.

Only distinct fingerprints are dealt.  Buckets stream by in key order and
are linked inside (a spanning set of links, never all pairs).  A bucket of
more than ``DENSE`` fingerprints isn't held in one task: its members go on
to the exact way for dense balls, where two fingerprints within 4 bits share
a point at most 2 bits from either.

Defined cases: a null or wordless text has fingerprint zero and links like
any other; a null id never becomes a component's id unless all ids in it are
null; repeated rows give repeated results; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.components import components
from tillroll.llm.tables import content_key, extended, materialize, unused

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
DENSE = 4096
#: Columns that the result adds; a document's own of these names give way.
RESULT = ("fp", "root", "component_id")


def fingerprint(data: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text.  bytes.lower() and
    bytes.split() know A-Z and the six ASCII blanks only, as asked."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split() if data else ()
    if not words:
        return 0
    flat = b" ".join(words)
    k = min(shingle_words, len(words))
    lens = np.fromiter(map(len, words), "int64", len(words)) + 1
    ends = np.cumsum(lens) - 1
    starts = (ends + 1 - lens)[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    hashes = np.fromiter((xxh64_intdigest(flat[s:e], SEED) for s, e in zip(starts, ends)), "uint64", len(starts))
    ones = np.zeros(64, "int64")
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view("uint8"), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype="uint32")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("uint64")[0])


def fingerprints(docs: DataFrame, text: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without ``text``, with ``fp`` (the fingerprint as a long)."""
    rest = [c for c in docs.columns if c != text and c.lower() not in RESULT]
    body = unused(docs, "_body")[0]
    given = docs.select(*rest, F.col(text).cast("binary").alias(body))
    schema = extended(given.select(*rest), {"fp": T.LongType()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle_words) for x in b.column(b.num_columns - 1)), "uint64", b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view("int64"))], names=[*rest, "fp"])

    return given.mapInArrow(work, schema)


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks over 64 bits, as signed longs."""
    size = (1 << (radius + 1)) - 1
    phi = [i % size + 1 for i in range(64)]
    out = []
    for v in range(1, size + 1):
        m = sum(1 << i for i in range(64) if (phi[i] & v).bit_count() % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def _spanning(fps, radius: int):
    """(member, first) links that join a bucket's components."""
    import numpy as np

    rest, links = fps, []
    while len(rest):
        first, rest = rest[0], rest[1:]
        queue = [first]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                links += [(int(x), int(first)) for x in found]
                queue += list(found)
    return links


def _buckets(batches: Iterator[pa.RecordBatch], handle, dense: int):
    """Feeds ``handle`` each bucket of 2 to ``dense`` values of a stream that
    comes in order of bucket; yields (values, past) of larger ones in pieces."""
    import numpy as np

    held_key, held = None, np.zeros(0, "uint64")
    past = False

    def ended():
        if len(held) > 1 and not past:
            handle(held)

    for b in batches:
        keys = b.column(0).to_numpy()
        vals = b.column(1).to_numpy().view("uint64")
        if not len(keys):
            continue
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        stop = np.r_[first[1:], len(keys)]
        many = (stop - first > 1) | (np.arange(len(first)) == len(first) - 1)
        many[0] = True
        for s, e in zip(first[many].tolist(), stop[many].tolist()):
            if held_key is None or keys[s] != held_key:
                ended()
                held_key, held, past = keys[s], vals[s:e], False
            else:
                held = np.concatenate([held, vals[s:e]])
            if past or len(held) > dense:
                past = True
                yield held
                held = held[:0]
    ended()


def covering_links(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """Links (lo, hi) whose components are those of all pairs of the distinct
    ``fp`` within ``radius`` bits."""
    tables = masks(radius)
    dealt = fps.select("fp", F.posexplode(F.array(*[F.lit(m) for m in tables])).alias("v", "mask")).select(
        F.xxhash64("v", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"), "fp"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        links: list[tuple[int, int]] = []

        def out(pairs, crowded):
            a = np.array(pairs, "uint64").reshape(-1, 2).view("int64")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[a.min(axis=1), crowded]), pa.array(np.r_[a.max(axis=1), crowded]),
                    pa.array(np.r_[np.zeros(len(a), bool), np.ones(len(crowded), bool)]),
                ],
                names=["lo", "hi", "dense"],
            )

        for crowd in _buckets(batches, lambda v: links.extend(_spanning(v, radius)), dense):
            yield out([], crowd.view("int64"))
            if len(links) > 100_000:
                yield out(links, np.zeros(0, "int64"))
                links.clear()
        yield out(links, np.zeros(0, "int64"))

    found = materialize(
        dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(link, "lo long, hi long, dense boolean"),
        "covering",
    )
    crowded = found.where("dense").select(F.col("lo").alias("fp")).distinct()
    return found.where("not dense").select("lo", "hi").union(ball_links(crowded, radius))


def ball_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The same links by shared points: each fingerprint is listed under
    every point at most half the radius away, and linked to the first one
    there.  As many rows as points, never pairs; a point's list is no longer
    than the number of points around it."""
    if radius % 2:
        raise ValueError("shared points need an even radius")
    near = [0] + [sum(1 << i for i in c) for d in range(1, radius // 2 + 1) for c in combinations(range(64), d)]
    near = [x - (1 << 64) if x >> 63 else x for x in near]
    rows = fps.select("fp", F.explode(F.array(*[F.lit(x) for x in near])).alias("x")).select(
        F.col("fp").bitwiseXOR(F.col("x")).alias("point"), "fp"
    )
    first = rows.groupBy("point").agg(F.min("fp").alias("lo"))
    return rows.join(first, "point").where("lo < fp").select("lo", F.col("fp").alias("hi")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` without ``text``, with ``fp``, ``root`` (the component's
    smallest fingerprint) and ``component_id`` (its smallest ``doc_id``)."""
    fps = materialize(fingerprints(docs, text, shingle_words), "fingerprints")
    # copies fall together before anything is compared
    distinct = fps.groupBy("fp").agg(F.min(doc_id).alias("first"))
    roots = components(covering_links(distinct.select("fp"), radius))
    labelled = distinct.join(roots, distinct.fp == roots.hi, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = labelled.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(by_fp, "fp")


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the one with its smallest id, and of
    rows with that same id the one with the smallest content key, once."""
    key = unused(docs, "_key")[0]
    keyed = docs.withColumn(key, content_key(docs))
    narrow = keyed.select(F.col(doc_id).alias("id"), F.col(key).alias("key"), F.col(text).alias("body"))
    found = near_duplicates(narrow, "body", "id", shingle_words, radius)
    # null ids last, so that a null stands only for a component of nulls
    best = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("x")
    stays = found.groupBy("root").agg(best)
    return keyed.join(stays.select(F.col("x.key").alias(key)), key, "left_semi").dropDuplicates([key]).drop(key)
