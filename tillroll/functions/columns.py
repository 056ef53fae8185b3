"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.sources import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revenue(quantity: str = S.QUANTITY, price: str = S.PRICE) -> Column:
    """Line revenue, exact: ``int * decimal(12,2)`` stays decimal."""
    return F.col(quantity) * F.col(price)


def as_double(c: str | Column) -> Column:
    """Money leaves the engine as double, converted once from the exact value."""
    return col(c).cast("double")


def month_index(ts: str = S.INVOICE_DATE) -> Column:
    """Months since year 0: consecutive calendar months differ by exactly 1."""
    return F.year(ts) * F.lit(12) + F.month(ts)


def valid_sale(
    start: str | None = None,
    end: str | None = None,
    cancel_prefix: str = "C",
    invoice: str = S.INVOICE,
    quantity: str = S.QUANTITY,
    price: str = S.PRICE,
    customer: str = S.CUSTOMER_ID,
    ts: str = S.INVOICE_DATE,
) -> Column:
    """Conjunction of the five cleaning conditions.

    A NULL invoice fails ``NOT startswith`` (NULL is not true), so lines
    without an invoice are removed as well.
    """
    date = F.col(ts).isNotNull()
    if start is not None:
        date = date & (F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        date = date & (F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return (
        (F.col(quantity) > 0)
        & (F.col(price) > 0)
        & F.col(customer).isNotNull()
        & ~F.col(invoice).startswith(cancel_prefix)
        & date
    )
