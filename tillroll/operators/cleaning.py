"""Q1: keep valid sale lines and attach the line revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.functions.columns import revenue, valid_sale
from tillroll.sources import schema as S

# The date window of Q1 over the star-derived sales (both
# bounds inclusive, to the second).
STAR_START = "1995-01-01 00:00:00"
STAR_END = "2000-12-31 23:59:59"


def clean(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    cancel_prefix: str = "C",
) -> DataFrame:
    """Sale lines with quantity > 0, price > 0, a known customer, an invoice
    not starting with ``cancel_prefix`` and a date, inside ``[start, end]``
    where these are given;
    plus ``revenue = quantity * price`` (exact decimal).

    A plain filter + projection: Catalyst pushes each condition down to the
    scan (or to the join side) that owns its columns.
    """
    return df.where(valid_sale(start, end, cancel_prefix)).withColumn(S.REVENUE, revenue())
