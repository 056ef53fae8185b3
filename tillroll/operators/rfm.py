"""Recency / frequency / monetary scoring and segmentation (Q10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import as_double
from tillroll.operators.ranking import global_ntiles, top_n_per_group
from tillroll.sources import schema as S

# Segment names and their ordered rules (first match wins;
# scores run 1..5, 5 best).
CHAMPIONS = "Champions"
LOYAL = "Loyal"
AT_RISK = "At-Risk"
LOST = "Lost"
OTHER = "Other"


def segment_expr(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    R, Fq, M = F.col(r), F.col(f), F.col(m)
    return (
        F.when((R >= 4) & (Fq >= 4) & (M >= 4), F.lit(CHAMPIONS))
        .when((R >= 3) & (Fq >= 3) & (M >= 3), F.lit(LOYAL))
        .when((R <= 2) & (Fq >= 3), F.lit(AT_RISK))
        .when((R <= 2) & (Fq <= 2), F.lit(LOST))
        .otherwise(F.lit(OTHER))
    )


def rfm_metrics(df: DataFrame, ts: str = S.INVOICE_DATE, recency: str = "calendar") -> DataFrame:
    """Per customer: recency_days (calendar days from the customer's last
    purchase to the last purchase of anyone), frequency (distinct
    invoices), monetary (exact spend).

    ``recency="elapsed"`` counts whole 24-hour periods instead of calendar
    days (23:00 -> 01:00 next day is 1 calendar day, 0 elapsed days).

    The reference date is the maximum of the per-customer last purchases, a
    scalar subquery.  It takes the maximum of whole rows, so that no column
    is pruned from it and it reuses the per-customer shuffle: the sale lines
    are read once.
    """
    per_customer = df.groupBy(S.CUSTOMER_ID).agg(
        F.max(ts).alias("_last"),
        F.countDistinct(S.INVOICE).alias("frequency"),
        F.sum(S.REVENUE).alias("monetary"),
    )
    ref = per_customer.agg(F.max(F.struct("_last", "frequency", "monetary"))["_last"].alias("ref")).scalar()
    if recency == "calendar":
        days = F.datediff(F.to_date(ref), F.to_date("_last"))
    elif recency == "elapsed":
        # whole 24-hour periods on the wall-clock values: no session time
        # zone (and no daylight-saving hour) enters
        days = F.timestamp_diff("DAY", F.col("_last"), ref).cast("int")
    else:
        raise ValueError(f"unknown recency {recency!r}")
    return per_customer.select(
        S.CUSTOMER_ID,
        days.alias("recency_days"),
        "frequency",
        "monetary",
    )


def rfm_scores(rfm: DataFrame, k: int = 5) -> DataFrame:
    """Quintile scores, 5 best: R from recency ascending, F and M from
    frequency / monetary descending, each tie broken by customer id."""
    specs = [("r_score", "recency_days", True), ("f_score", "frequency", False), ("m_score", "monetary", False)]
    out = global_ntiles(rfm, k, S.CUSTOMER_ID, specs)
    for name, _, _ in specs:
        out = out.withColumn(name, F.lit(k + 1) - F.col(name))
    return out


def rfm_segments(df: DataFrame, ts: str = S.INVOICE_DATE) -> DataFrame:
    """Q10: customer_id, recency_days, frequency, monetary, r_score,
    f_score, m_score, segment."""
    scored = rfm_scores(rfm_metrics(df, ts))
    return scored.select(
        S.CUSTOMER_ID,
        "recency_days",
        "frequency",
        as_double("monetary").alias("monetary"),
        F.col("r_score").cast("int").alias("r_score"),
        F.col("f_score").cast("int").alias("f_score"),
        F.col("m_score").cast("int").alias("m_score"),
        segment_expr().alias("segment"),
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Q10b: customers and revenue (rounded to cents) per segment."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.sum(F.col("monetary").cast("decimal(22,2)")), 2).cast("double").alias("segment_revenue"),
        )
        .orderBy(F.desc("segment_revenue"), "segment")
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    """Q10c: customers per segment, largest first."""
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "segment")


def top_per_segment(segments: DataFrame, n: int = 5) -> DataFrame:
    """Q10d: the ``n`` biggest spenders of every segment."""
    ranked = top_n_per_group(
        segments, ["segment"], [F.desc("monetary"), F.asc(S.CUSTOMER_ID)], n, rank_name="rank_in_segment"
    )
    return ranked.select("segment", S.CUSTOMER_ID, "recency_days", "frequency", "monetary").orderBy(
        "segment", F.desc("monetary"), S.CUSTOMER_ID
    )
