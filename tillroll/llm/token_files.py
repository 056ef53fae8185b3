"""Token ids of a corpus as range-ANS blocks, written and read back.

Layout under ``path``: ``frequencies`` (id, freq) -- the one table that all
blocks share -- and ``blocks``, in folders ``part=N`` of ascending document
id: a row has the position of its first id in the whole stream, its
documents with their numbers of ids, and the coded block.  A block holds
whole documents, ``BLOCK_IDS`` ids or one longer document, so any task
decodes any block by itself; a longer one can be entered at its checkpoints.

Writing: the texts are dealt by ranges of the id, encoded once and kept as a
table; ids are counted over that whole table, then coded.  Written tables
carry the job over lost executors.

Defined cases: a null text is empty (its end id remains); null ids come
first, ties go by the text's hash; repeated rows are repeated; an empty
table gives no blocks; ids count as longs, and such as don't are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.rans import Coder, quantised
from tillroll.llm.tables import materialize
from tillroll.sources.files import remove

BLOCK_IDS = 1 << 17


def encoded(docs: DataFrame, vocab_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(part, at, doc_id, n_tokens, ids): in order of the id; ``at`` counts
    the ids before it in the same part."""
    order = ["doc_id", "tie"]
    given = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
        .withColumn("tie", F.xxhash64("body")).repartitionByRange(*order).sortWithinPartitions(*order)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        from tillroll.llm.bpe import encoder, in_portions

        enc, part, at = encoder(vocab_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            for texts, first in in_portions(b.column(1)):
                ids = [x + end for x in enc.encode(texts)]
                n = np.fromiter(map(len, ids), "int64", len(ids)) // np.dtype(enc.dtype).itemsize
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, "int32")), pa.array(before), b.column(0).slice(first, len(ids)), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "at", "doc_id", "n_tokens", "ids"],
                )

    return given.select("doc_id", "body").mapInArrow(work, "part int, at long, doc_id long, n_tokens long, ids binary")


def _counts(tokens: DataFrame, vocab: int, dtype: str):
    """Occurrences of each id, over all documents; a row for each id."""
    import numpy as np

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, "int64")
        for b in batches:
            if not b.num_rows:
                continue
            ends = np.frombuffer(b.column(0).buffers()[1], "int32")[b.column(0).offset :][: b.num_rows + 1]
            ids = np.frombuffer(b.column(0).buffers()[2], "uint8")[ends[0] : ends[-1]].view(dtype)  # no row is null
            total += np.bincount(ids, minlength=vocab)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype("int32")), pa.array(total[seen])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(work, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocab, "int64")
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_tokens(docs: DataFrame, path: str, vocab_path: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", block_ids: int = BLOCK_IDS) -> None:
    from tillroll.llm.bpe import encoder

    spark = docs.sparkSession
    enc = encoder(vocab_path)
    vocab, dtype = enc.vocab, enc.dtype
    tokens = materialize(encoded(docs, vocab_path, end_id, text, doc_id), "tokens", compression="zstd")
    freqs = quantised(_counts(tokens, vocab, dtype))
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freqs) if f], "id int, freq int").coalesce(1).write.mode("overwrite").parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(freqs)
    # a number for each part: as many as tasks
    sums = sorted((r["part"], r["n"]) for r in tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base, total = {}, 0
    for part, n in sums:
        base[part], total = total, total + n

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        coder = Coder(shared.value)
        part, start, doc_ids, lens, ids = None, 0, [], [], []

        def block():
            coded = coder.encode(np.frombuffer(b"".join(ids), dtype))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([start + base[part]]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int64())),
                    pa.array([coded], pa.binary()), pa.array([part], pa.int32()),
                ],
                names=["start", "doc_ids", "n_tokens", "block", "part"],
            )

        held = 0
        for b in batches:
            for p, at, doc, n, x in zip(*(b.column(i) for i in range(5))):
                p, at, n = p.as_py(), at.as_py(), n.as_py()
                if doc_ids and (p != part or at != start + held or held + n > block_ids):
                    yield block()
                    doc_ids, lens, ids, held = [], [], [], 0
                if not doc_ids:
                    part, start = p, at
                doc_ids.append(doc.as_py())
                lens.append(n)
                ids.append(x.as_py())
                held += n
        if doc_ids:
            yield block()

    blocks = tokens.mapInArrow(work, "start long, doc_ids array<long>, n_tokens array<long>, block binary, part int")
    blocks.write.mode("overwrite").partitionBy("part").option("compression", "none").parquet(f"{path}/blocks")
    shared.unpersist()
    remove(tokens)


def _documents(spark: SparkSession, path: str, schema: str, emit) -> DataFrame:
    """Decodes blocks; ``emit`` gets (doc_ids, starts, list of id arrays)."""
    import numpy as np

    table = spark.read.schema("id int, freq int").parquet(f"{path}/frequencies").collect()  # a vocabulary at most
    freqs = np.zeros(max((r["id"] for r in table), default=0) + 1, "int64")
    for r in table:
        freqs[r["id"]] = r["freq"]
    shared = spark.sparkContext.broadcast(freqs)
    blocks = spark.read.schema("start long, doc_ids array<long>, n_tokens array<long>, block binary, part int").parquet(f"{path}/blocks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for start, docs, lens, block in zip(*(b.column(i) for i in range(4))):
                ids, n = coder.decode(block.as_py()), np.array(lens.as_py(), "int64")
                if len(ids) != n.sum():
                    raise ValueError("damaged block")
                ends = np.cumsum(n)
                yield emit(docs.values, start.as_py() + ends - n, np.split(ids, ends[:-1]))

    return blocks.select("start", "doc_ids", "n_tokens", "block").mapInArrow(work, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document."""
    def emit(docs, starts, ids):
        return pa.RecordBatch.from_arrays([docs, pa.array(starts), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return _documents(spark, path, "doc_id long, start long, ids array<int>", emit)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its ids."""
    def emit(docs, starts, ids):
        import zlib

        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return pa.RecordBatch.from_arrays(
            [docs, pa.array(starts), pa.array(list(map(len, ids)), pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return _documents(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", emit)
