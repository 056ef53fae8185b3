"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations and two joins on the node; a hub's links are
summed before the shuffle and, as one side of a plain equi-join, split by
adaptive execution.  Rounds are written tables, so a lost executor costs one
round at most and the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import materialize


def _star_round(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    root = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("w"), "m")
    small = large.join(root, F.col("hi") == F.col("w")).select(
        F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x")
    )
    return small.select("x.*").where("hi > lo").distinct()


def components(links: DataFrame) -> DataFrame:
    """(hi, root) for every node of ``links`` (lo < hi, longs) but the roots,
    which are the smallest of their components."""
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()

    current = materialize(links.select("lo", "hi").where("lo < hi").distinct(), "links")
    before = state(current)
    while before[0]:
        current = materialize(_star_round(current), "links")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select("hi", F.col("lo").alias("root"))
