"""A calendar of years, to join to the year-partitioned copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.files import YEAR


def years(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(year, days, first_weekday) from ``first`` to ``last``: a row for each
    year; Monday is 0."""
    start = F.make_date(F.col(YEAR), F.lit(1), F.lit(1))
    table = spark.range(int(first), int(last) + 1, 1, 1).select(F.col("id").cast("int").alias(YEAR))
    return table.select(YEAR, F.dayofyear(F.make_date(F.col(YEAR), F.lit(12), F.lit(31))).alias("days"), F.weekday(start).alias("first_weekday"))


def in_years(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """The sale lines of the calendar's years (``sales`` read with
    ``keep_year``).  The calendar has a row for a year, so it is broadcast;
    its filters decide at run time which directories are read."""
    return sales.join(F.broadcast(calendar.select(YEAR)), YEAR, "left_semi")
