"""Small literal sale-line tables for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillroll.sources.schema import SALES_SCHEMA


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def line(
    invoice="100",
    stock_code=1,
    description="red widget",
    quantity=1,
    invoice_date="1996-05-01 10:00:00",
    price="2.50",
    customer_id=7,
    country="NATION_1",
):
    return (
        invoice,
        None if stock_code is None else str(stock_code),
        description,
        quantity,
        ts(invoice_date) if isinstance(invoice_date, str) else invoice_date,
        None if price is None else Decimal(price),
        customer_id,
        country,
    )


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def executed_plan_text(df) -> str:
    """Final adaptive plan, after running the query itself once."""
    df.collect()
    return plan_text(df, "formatted")
