"""Explicit reuse of an intermediate across several actions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` cached while several actions read it, and release it
    afterwards.

    Inside one query Spark already shares a shuffle between branches; this
    is for separate actions (e.g. a top-10 list and the above-mean list
    from the same per-customer totals).  Blocks lost with an executor are
    recomputed from the lineage, so the cache only saves work and never
    changes results; the cache is filled by the first action.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
