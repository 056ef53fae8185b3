"""Global and grouped revenue aggregates (Q2, Q3, customer / invoice totals)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import as_double, col
from tillroll.sources import schema as S


def summary(df: DataFrame) -> DataFrame:
    """Q2: one row -- total revenue, distinct invoices, distinct customers,
    largest line revenue, first and last invoice date, mean invoice total.

    Sale lines are reduced to one row per (invoice, customer) with a
    map-side partial aggregate; everything else is one aggregate over those
    rows, so the lines are read once and what the two distinct counts copy
    are reduced rows.  The mean is the revenue over the number of invoices,
    a NULL invoice being one.
    """
    lines = df.groupBy(S.INVOICE, S.CUSTOMER_ID).agg(
        F.sum(S.REVENUE).alias("rev"),
        F.max(S.REVENUE).alias("max_rev"),
        F.min(S.INVOICE_DATE).alias("first_date"),
        F.max(S.INVOICE_DATE).alias("last_date"),
    )
    one = lines.agg(
        F.sum("rev").alias("total"),
        F.countDistinct(S.INVOICE).alias("distinct_invoices"),
        F.countDistinct(S.CUSTOMER_ID).alias("distinct_customers"),
        F.max("max_rev").alias("max_rev"),
        F.min("first_date").alias("min_invoice_date"),
        F.max("last_date").alias("max_invoice_date"),
        F.max(F.col(S.INVOICE).isNull().cast("int")).alias("null_invoice"),
    )
    groups = F.col("distinct_invoices") + F.coalesce("null_invoice", F.lit(0))
    return one.select(
        as_double("total").alias("total_revenue"),
        F.col("distinct_invoices"),
        F.col("distinct_customers"),
        as_double("max_rev").alias("max_line_revenue"),
        F.col("min_invoice_date"),
        F.col("max_invoice_date"),
        F.try_divide(as_double("total"), groups.cast("double")).alias("avg_order_value"),
    )


def revenue_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    distinct_of: str = S.INVOICE,
    count_name: str = "order_count",
    sort: bool = True,
) -> DataFrame:
    """Revenue and distinct ``distinct_of`` count per group of ``keys``
    (columns or expressions such as ``F.year(ts).alias("year")``).

    Spark plans the single distinct count in two shuffles, the first keyed
    by (group, invoice), so a group holding a large share of the lines is
    still spread over many tasks.  Sorted by revenue, largest first, with
    the group keys as tie-break.
    """
    keys = [col(k) for k in keys]
    out = df.groupBy(*keys).agg(
        as_double(F.sum(S.REVENUE)).alias("revenue"),
        F.countDistinct(distinct_of).alias(count_name),
    )
    if sort:
        names = [c for c in out.columns if c not in ("revenue", count_name)]
        out = out.orderBy(F.desc("revenue"), *[F.asc_nulls_first(n) for n in names])
    return out


def customer_totals(df: DataFrame, keys: Sequence[str] = (S.CUSTOMER_ID,)) -> DataFrame:
    """Exact (decimal) spend per customer, or per any key list."""
    return df.groupBy(*keys).agg(F.sum(S.REVENUE).alias("total_spend"))


def invoice_totals_mean(df: DataFrame) -> DataFrame:
    """Mean invoice total: an aggregate of an aggregate (two levels)."""
    per_invoice = df.groupBy(S.INVOICE).agg(F.sum(S.REVENUE).alias("invoice_total"))
    return per_invoice.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.try_divide(as_double(F.sum("invoice_total")), F.count(F.lit(1)).cast("double")).alias("avg_order_value"),
    )
