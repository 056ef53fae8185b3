"""Comparison of group totals with their global mean (Q7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import as_double
from tillroll.operators.aggregates import customer_totals
from tillroll.sources import schema as S


def mean_of(
    df: DataFrame, value: str, name: str = "mean", empty_mean: float | None = None
) -> DataFrame:
    """One-row frame with the mean of ``value``: the exact sum over the
    count, as double; NULL for no rows unless ``empty_mean`` is given."""
    mean = F.try_divide(as_double(F.sum(value)), F.count(value).cast("double"))
    if empty_mean is not None:
        mean = F.coalesce(mean, F.lit(float(empty_mean)))
    return df.agg(mean.alias(name))


def above_mean(
    totals: DataFrame,
    value: str = "total_spend",
    baseline_name: str = "avg_spend_baseline",
    empty_mean: float | None = None,
) -> DataFrame:
    """Rows whose ``value`` exceeds the mean of ``value``, mean attached.

    The mean is a scalar subquery of the same plan: no driver round trip,
    no join, and Spark reads the totals' shuffle once for both uses
    (``ReusedExchange``).  The mean of no rows is NULL (as in SQL) unless
    ``empty_mean`` is given.
    """
    baseline = mean_of(totals, value, baseline_name, empty_mean).scalar()
    return totals.where(as_double(value) > baseline).withColumn(baseline_name, baseline)


def above_mean_customers(df: DataFrame) -> DataFrame:
    """Q7: customer_id, total_spend, avg_spend_baseline; biggest first."""
    return (
        above_mean(customer_totals(df))
        .select(S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"), "avg_spend_baseline")
        .orderBy(F.desc("total_spend"), S.CUSTOMER_ID)
    )
