"""Shards of near equal bytes by Karmarkar-Karp differencing.

Documents with equal texts stay together, so the things to place are groups.
Each group starts as a partial partition: its bytes in one shard, nothing in
the others.  The two partial partitions of largest spread are combined,
fullest shard with emptiest, until one is left.

In Spark: groups are dealt by hash into parts of about ``FAN``; each part is
differenced by a task of its own into one partial partition, and those are
dealt and differenced again, level by level, until one part is left.  The
shards are then traced back down.  However many groups, no task holds more
than a part; levels grow with the logarithm of their number.  Documents get
their shard by a join on the group (a group of very many copies is split by
adaptive execution), and their slots by a numbering over ranges.

Defined cases: a null text is empty, and so equal to an empty one; null ids
are kept; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import materialize, no_text, numbered, unused

#: Partial partitions differenced together, on average.
FAN = 4096


def difference(vectors):
    """Combines partial partitions (rows of loads).  Returns the final loads,
    fullest first, and for each row the final place of each of its shards."""
    import heapq

    import numpy as np

    n, k = vectors.shape
    order = np.argsort(-vectors, axis=1, kind="stable")
    loads = list(np.take_along_axis(vectors, order, axis=1))
    heap = [(-int(v[0] - v[-1]), i) for i, v in enumerate(loads)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = loads[a] + loads[b][::-1]
        o = np.argsort(-both, kind="stable")
        loads.append(both[o])
        loads[a] = loads[b] = None
        merges.append((a, b, o))
        heapq.heappush(heap, (-int(both[o[0]] - both[o[-1]]), len(loads) - 1))
    places: list = [None] * len(loads)
    places[-1] = np.arange(k)
    for node in range(len(loads) - 1, n - 1, -1):
        a, b, o = merges[node - n]
        at = np.empty(k, "int64")
        at[o] = places[node]
        places[a], places[b] = at, at[::-1]
        places[node] = None
    out = np.empty((n, k), "int32")
    for i in range(n):
        out[i, order[i]] = places[i]
    return loads[-1], out


def _level(items: DataFrame, shards: int, parts: int) -> DataFrame:
    """(id, parent, places, loads): ``items`` (id, loads) differenced in parts;
    ``loads`` of the part stands with its first item only."""
    dealt = items.select("id", "loads", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(parts)).alias("parent"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        table = pa.Table.from_batches(batches).sort_by([("id", "ascending")])
        flat = table.column("loads").combine_chunks().flatten().to_numpy().reshape(-1, shards)
        final, places = difference(flat)
        n = len(flat)
        ends = np.arange(0, (n + 1) * shards, shards, dtype="int32")
        yield pa.RecordBatch.from_arrays(
            [
                table.column("id").combine_chunks(), table.column("parent").combine_chunks(),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(places.ravel())),
                pa.array([final.tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
            ],
            names=["id", "parent", "places", "loads"],
        )

    return dealt.groupBy("parent").applyInArrow(
        lambda t: pa.Table.from_batches(work(t.to_batches())), "id long, parent long, places array<int>, loads array<long>"
    )


def balanced(groups: DataFrame, shards: int, fan: int = FAN) -> DataFrame:
    """(id, shard) of ``groups`` (id, bytes); ids are distinct longs."""
    items = groups.select("id", F.concat(F.array(F.col("bytes").cast("long")), F.array_repeat(F.lit(0).cast("long"), shards - 1)).alias("loads"))
    levels, n = [], groups.count()
    while True:
        parts = max(1, -(-n // fan))
        done = materialize(_level(items, shards, parts), "differenced")
        levels.append(done)
        if parts == 1:
            break
        items = done.where("loads is not null").select(F.col("parent").alias("id"), "loads")
        n = items.count()  # parts that no group fell to don't count
    final = levels.pop().select("id", "places")
    while levels:
        up = final.select(F.col("id").alias("parent"), F.col("places").alias("above"))
        final = levels.pop().join(up, "parent").select("id", F.transform("places", lambda p: F.col("above")[p]).alias("places"))
    return final.select("id", F.col("places")[0].alias("shard"))


def sharded(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id", fan: int = FAN) -> DataFrame:
    """``docs`` without ``text``, with size, text_crc32, shard and slot;
    columns of ``docs`` called like these give way."""
    body, group = unused(docs, "_body", "_group")
    rest = [c for c in docs.columns if c != text and c.lower() not in ("size", "text_crc32", "shard", "slot")]
    sized = docs.select(
        *rest, (F.octet_length(no_text(text)) + 16).cast("long").alias("size"),
        F.crc32(no_text(text).cast("binary")).alias("text_crc32"),
        # one 64-bit hash: two texts that share it merely go together
        F.xxhash64(F.xxhash64(no_text(text)), F.crc32(no_text(text).cast("binary")), F.octet_length(no_text(text))).alias(group),
    )
    sized = materialize(sized, "sized")
    groups = materialize(sized.groupBy(F.col(group).alias("id")).agg(F.sum("size").alias("bytes")), "groups")
    placed = balanced(groups, shards, fan).withColumnRenamed("id", group)
    return numbered(sized.join(placed, group).drop(group), ["shard", doc_id, "text_crc32", "size"], "slot", per="shard")
