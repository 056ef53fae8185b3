"""Small lookup tables given as rows (country -> region and the like)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def lookup_from_pairs(
    spark: SparkSession, pairs: Iterable[tuple[str, str]], key: str = "country", value: str = "region"
) -> DataFrame:
    """A two-column string table from ``(key, value)`` pairs held by the caller."""
    schema = T.StructType([T.StructField(key, T.StringType(), True), T.StructField(value, T.StringType(), True)])
    return spark.createDataFrame(list(pairs), schema)
