"""Token counts as delta-maintained rollups.

A change feed has signed rows: an insert is +1 with the new row, a delete -1
with the old row, a revision (of text, source, language or of the counting
itself) both.  A batch's rows are counted under every tokenizer version and
summed to one row for each source, language and version; those sums are all
that the store keeps.  Totals are sums over batches, so nothing counted
before is read again.  Rows that several batches use may be counted once
(``counted``) and go on as numbers.

A batch is committed under its name: the deltas are written to a folder of
that name, by Spark's own commit, and a marker table after them.  A batch
that has its marker is skipped, one without is written anew, and totals read
marked batches only -- a repeated or interrupted commit changes nothing.
Names are escaped in the folders' names, so any text but the empty one is a
name.

Defined cases: a null text has no tokens but counts as a document; null
sources and languages are groups; repeated rows count as often as they
stand; an empty batch commits no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.tables import extended, unused
from tillroll.sources.files import exists

TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def signed(rows: DataFrame, sign: int, source: str = "source", lang: str = "lang", text: str = "text") -> DataFrame:
    """Rows of a change feed."""
    return rows.select(
        F.lit(sign).alias("sign"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("binary").alias("body"),
    )


def signed_counts(rows: DataFrame, sign: int, source: str = "source", lang: str = "lang", tokens: str = "tokens") -> DataFrame:
    """Rows of a change feed that are counted already."""
    return rows.select(F.lit(sign).alias("sign"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(tokens).alias("tokens"))


def revised(old: DataFrame, new: DataFrame, feed=signed) -> DataFrame:
    """A feed that takes ``old`` rows back for ``new`` ones."""
    return feed(old, -1).union(feed(new, 1))


def counted(docs: DataFrame, tokenizers: dict[str, str], text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` without ``text``, with ``out``: its tokens under every version,
    an array in the versions' order.  A column called like it gives way."""
    rest = [c for c in docs.columns if c != text and c.lower() != out.lower()]
    given = docs.select(*rest, F.col(text).cast("binary").alias(unused(docs, "_body")[0]))
    schema = extended(given.select(*rest), {out: T.ArrayType(T.LongType())})
    paths = list(tokenizers.values())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from tillroll.llm.bpe import encoder, in_portions

        for b in batches:
            for texts, first in in_portions(b.column(b.num_columns - 1)):
                counts = []
                for path in paths:
                    enc = encoder(path)
                    counts.append(np.fromiter(map(len, enc.encode(texts)), "int64", len(texts)) // np.dtype(enc.dtype).itemsize)
                part = b.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.stack(counts, 1).tolist(), pa.list_(pa.int64()))], names=[*rest, out])

    return given.mapInArrow(work, schema)


def deltas(feed: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """Sums of a feed by source, language and version.  ``tokenizers``:
    version -> vocabulary file.  Tasks sum up what they count, so a source
    that holds most rows shuffles as little as any."""
    sums = [F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")]
    if "tokens" in feed.columns:
        names = F.array(*[F.lit(v) for v in tokenizers])
        each = feed.select("sign", "source", "lang", F.posexplode("tokens").alias("at", "n"))
        each = each.select("source", "lang", F.get(names, F.col("at")).alias("tokenizer"), F.col("sign").cast("long").alias("docs"), (F.col("sign") * F.col("n")).alias("tokens"))
        return each.groupBy("source", "lang", "tokenizer").agg(*sums)
    spark_schema = "source string, lang string, tokenizer string, docs long, tokens long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import numpy as np

        from tillroll.llm.bpe import encoder, in_portions

        docs, tokens = Counter(), Counter()

        def out():
            keys = list(docs)
            done = pa.RecordBatch.from_arrays(
                [
                    *[pa.array([k[i] for k in keys], pa.string()) for i in range(3)],
                    pa.array([docs[k] for k in keys], pa.int64()), pa.array([tokens[k] for k in keys], pa.int64()),
                ],
                names=["source", "lang", "tokenizer", "docs", "tokens"],
            )
            docs.clear()
            tokens.clear()
            return done

        for b in batches:
            sign, source, lang = (b.column(i).to_pylist() for i in range(3))
            for texts, first in in_portions(b.column(3)):
                for version, path in tokenizers.items():
                    enc = encoder(path)
                    width = np.dtype(enc.dtype).itemsize
                    for i, ids in enumerate(enc.encode(texts), first):
                        k = source[i], lang[i], version
                        docs[k] += sign[i]
                        tokens[k] += sign[i] * (len(ids) // width)
            if len(docs) > 50_000:  # as many sources as rows: on with it
                yield out()
        yield out()

    part = feed.select("sign", "source", "lang", "body").mapInArrow(work, spark_schema)
    return part.groupBy("source", "lang", "tokenizer").agg(*sums)


class Rollup:
    """A store of committed batches under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, str]):
        self.spark, self.path, self.tokenizers = spark, path.rstrip("/"), tokenizers

    @staticmethod
    def _folder(batch: str) -> str:
        if not batch:
            raise ValueError("a batch needs a name")
        # no name is a number or Spark's word for null; no % is left for Spark to read
        return "batch=b-" + quote(batch, safe="").replace(".", "%2E").replace("~", "%7E").replace("%", "~")

    def committed(self, batch: str) -> bool:
        return exists(self.spark, f"{self.path}/marks/{self._folder(batch)}/_SUCCESS")

    def commit(self, batch: str, feed: DataFrame) -> bool:
        """False if the batch was committed before."""
        if self.committed(batch):
            return False
        folder = self._folder(batch)
        to = f"{self.path}/deltas/{folder}"
        deltas(feed, self.tokenizers).write.mode("overwrite").parquet(to)
        self.spark.sql("select 1 as committed").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/{folder}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens; groups that deltas have
        brought to nothing are left out."""
        if not exists(self.spark, f"{self.path}/marks"):
            return self.spark.createDataFrame([], TOTALS)
        log = self.spark.read.schema(f"{TOTALS}, batch string").parquet(f"{self.path}/deltas")
        marks = self.spark.read.schema("committed int, batch string").parquet(f"{self.path}/marks")
        return (
            log.join(marks, "batch", "left_semi").groupBy("source", "lang", "tokenizer")
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        )
