"""The corpus pipeline: quality rules, near-duplicates, benchmark
decontamination, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns a frame with the columns
of ``docs`` -- the last one the document's id and pieces -- and is written
and read again before the next.  ``run`` does that for the documents of
``sf_dir``.

Defined cases are those of the operators: null texts fail the quality rules,
repeated rows are one document to the second stage, empty tables pass
through, and other columns ride along whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, pii, quality, simhash, unigram
from tillroll.llm.queries import vocabulary
from tillroll.llm.tables import documents, materialize, table
from tillroll.sources.files import remove


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the common lines of those that stay."""
    return quality.good(docs, host="source" if "source" in docs.columns else None)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.deduplicated(docs).select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redact(docs).select(*docs.columns)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids; ``exact`` says that they decode to the text."""
    model = unigram.load(spark, vocabulary("piece_bpe_32k.model"))
    back = unigram.round_trip(docs.select("doc_id", "text"), model)
    return back.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "exact")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("pieces", as_pieces),
]

#: Fingerprints, expressions found by bootstrapping and pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs, before = materialize(stage(spark, docs, sf_dir), name), written
        if before is not None:
            remove(before)  # read for the last time
        written = docs
    return docs
