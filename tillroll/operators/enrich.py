"""Lookup enrichment (Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import as_double
from tillroll.sources import schema as S

#: A key is hot if more than this part of the fact rows have it.
HOT_PART = 1000


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    default: str | None = None,
) -> DataFrame:
    """Left join ``fact`` to a lookup ``dim`` on ``key`` (kept once);
    unmatched keys get NULL, or ``default`` when given.

    No hint: Spark broadcasts the lookup by its measured bytes
    (``autoBroadcastJoinThreshold``), and splits skewed keys otherwise.
    """
    out = fact.join(dim.select(key, value), key, "left")
    if default is not None:
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
    return out


def hot_lookup_join(
    fact: DataFrame, dim: DataFrame, key: str, value: str, default: str | None = None, hot_part: int = HOT_PART
) -> DataFrame:
    """``lookup_join`` for a lookup too large to broadcast and keys of any
    skew, adaptive execution or not.

    The keys that more than a ``hot_part``-th of the fact rows have -- so at
    most ``hot_part`` keys -- are measured by one counting aggregate; their
    rows of the lookup are broadcast, and their fact rows stay where they
    are.  All other keys, small by that measure, are shuffled; rows without a
    key are joined with nothing.  ``dim`` has one row for a key; the fact is
    read twice.
    """
    flag, found = "_hot", "_value"
    sizes = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    every = sizes.agg(F.sum("_n")).scalar()
    hot = sizes.where(F.col("_n") * hot_part > every).select(key)
    lookup = dim.select(key, F.col(value).alias(found))
    small = F.broadcast(hot.join(lookup, key, "left").select(F.col(key).alias("_key"), F.lit(True).alias(flag), found))
    marked = fact.join(small, F.col(key) == F.col("_key"), "left").drop("_key")
    still = F.col(flag) | F.col(key).isNull()
    near = marked.where(F.coalesce(still, F.lit(False))).drop(flag)
    far = marked.where(~F.coalesce(still, F.lit(False))).drop(flag, found).join(lookup.hint("merge"), key, "left")
    label = F.col(found) if default is None else F.coalesce(F.col(found), F.lit(default))
    rows = near.unionByName(far)
    return rows.select(*[F.col(c) for c in fact.columns], label.alias(value))


def revenue_by_region(
    df: DataFrame,
    lookup: DataFrame,
    default: str | None = None,
) -> DataFrame:
    """Q8: region, revenue, distinct_customers; biggest revenue first."""
    enriched = lookup_join(
        df.select(S.COUNTRY, S.CUSTOMER_ID, S.REVENUE), lookup, S.COUNTRY, "region", default
    )
    return (
        enriched.groupBy("region")
        .agg(
            as_double(F.sum(S.REVENUE)).alias("revenue"),
            F.countDistinct(S.CUSTOMER_ID).alias("distinct_customers"),
        )
        .orderBy(F.desc("revenue"), F.asc_nulls_first("region"))
    )
