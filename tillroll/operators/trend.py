"""Time-axis operators: monthly series with running total and trailing mean
(Q5), and the shifted self-join for period-over-period change (Q9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import as_double, month_index
from tillroll.sources import files
from tillroll.sources import schema as S


def monthly_revenue(df: DataFrame, ts: str = S.INVOICE_DATE) -> DataFrame:
    """Exact revenue per calendar (year, month)."""
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.sum(S.REVENUE).alias("revenue")
    )


def running_stats(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    trailing_rows: int = 3,
    total_name: str = "cumulative",
    mean_name: str = "moving_avg",
) -> DataFrame:
    """Running total and mean of the last ``trailing_rows`` rows (a ROWS
    frame: a missing period is skipped over, the first rows average fewer).

    Both use one window order, so Spark evaluates them in one Window node.
    The mean is the exact frame sum over the frame row count, converted to
    double once.  Unpartitioned: meant for series of bounded length (one
    row per month); ``running_stats_by_range`` is for row-level data.
    """
    base = Window.orderBy(*order)
    run = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trail = base.rowsBetween(-(trailing_rows - 1), Window.currentRow)
    return df.select(
        *df.columns,
        as_double(F.sum(value).over(run)).alias(total_name),
        (as_double(F.sum(value).over(trail)) / F.count(value).over(trail).cast("double")).alias(mean_name),
    )


def running_stats_by_range(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    trailing_rows: int = 3,
    total_name: str = "cumulative",
    mean_name: str = "moving_avg",
) -> DataFrame:
    """``running_stats`` for series of any length: a prefix scan over ranges.

    The rows are dealt by ranges of ``order`` (which should be unique; nulls
    first), sorted in tasks and written with their task and place.  Each
    task's rows are then summed on their own; what the tasks before hold is
    one row for each task, summed up on the driver and joined back.  For the
    trailing mean a task also gets the last ``trailing_rows - 1`` rows before
    its first one, wherever they lie (the halo), and drops them again.  No
    window is over more than a task's range.

    ``value`` should be a whole or decimal number, so that sums don't depend
    on where ranges end.  Starts jobs.
    """
    spark, n_halo = df.sparkSession, trailing_rows - 1
    keys = [F.asc_nulls_first(c) for c in order]
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(row, F.col(value).alias("_v"), F.monotonically_increasing_id().alias("_at"))
    dealt = files.materialize(dealt, "series")
    task, place = F.shiftright("_at", 33).cast("int").alias("_task"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place")
    rows = dealt.select("_row", "_v", task, place)
    zero = F.lit(0).cast(dealt.schema["_v"].dataType)
    # a row for each task
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_v"), zero).alias("s"), F.count("_v").alias("c"))
    starts, at, total = [], 0, None
    for r in sorted(sizes.collect()):
        starts.append((r["_task"], at, r["n"], total))
        at += r["n"]
        if r["c"]:
            total = r["s"] if total is None else total + r["s"]
    schema = T.StructType([
        T.StructField("_task", T.IntegerType()), T.StructField("_start", T.LongType()), T.StructField("_n", T.LongType()),
        T.StructField("_before", sizes.schema["s"].dataType),
    ])
    known = F.broadcast(spark.createDataFrame(starts, schema))
    placed = rows.join(known, "_task")
    own = placed.select("_row", "_v", "_task", "_place", "_before", F.lit(True).alias("_own"))
    # a row's halo reaches the tasks that start up to n_halo rows on
    tails = placed.where(F.col("_place") >= F.col("_n") - n_halo).select("_v", (F.col("_start") + F.col("_place")).alias("_global"))
    reached = F.sequence(F.col("_global") + 1, F.col("_global") + n_halo) if n_halo else F.array().cast("array<bigint>")
    tails = tails.withColumn("_start", F.explode(reached))
    begins = known.select("_task", "_start", "_before").where("_start > 0")
    ghost = tails.join(F.broadcast(begins), "_start").select(
        F.lit(None).cast(dealt.schema["_row"].dataType).alias("_row"), "_v", "_task", (F.col("_global") - F.col("_start")).alias("_place"), "_before", F.lit(False).alias("_own")
    )
    local = Window.partitionBy("_task").orderBy("_place")
    run = local.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    trail = local.rowsBetween(-n_halo, Window.currentRow)
    mine = F.when(F.col("_own"), F.col("_v"))
    every = own.unionByName(ghost).select(
        "*", F.sum(mine).over(run).alias("_sum"), F.sum("_v").over(trail).alias("_tsum"), F.count("_v").over(trail).alias("_tn")
    )
    total = F.when(F.col("_before").isNull(), F.col("_sum")).otherwise(F.col("_before") + F.coalesce("_sum", zero))
    return every.where("_own").select(
        "_row.*", as_double(total).alias(total_name), (as_double(F.col("_tsum")) / F.col("_tn").cast("double")).alias(mean_name)
    )


def monthly_trend(df: DataFrame, ts: str = S.INVOICE_DATE, trailing_rows: int = 3) -> DataFrame:
    """Q5: year, month, revenue, cumulative_revenue, moving_avg_3mo."""
    monthly = monthly_revenue(df, ts)
    out = running_stats(
        monthly,
        "revenue",
        ["year", "month"],
        trailing_rows,
        total_name="cumulative_revenue",
        mean_name=f"moving_avg_{trailing_rows}mo",
    )
    return out.select(
        "year",
        "month",
        as_double("revenue").alias("revenue"),
        "cumulative_revenue",
        f"moving_avg_{trailing_rows}mo",
    ).orderBy("year", "month")


def customer_month_spend(df: DataFrame, ts: str = S.INVOICE_DATE) -> DataFrame:
    return df.groupBy(S.CUSTOMER_ID, month_index(ts).alias("month_index")).agg(
        F.sum(S.REVENUE).alias("month_spend")
    )


def period_over_period(
    periodic: DataFrame,
    entity: str = S.CUSTOMER_ID,
    period: str = "month_index",
    value: str = "month_spend",
    step: int = 1,
    merge_hint: bool = True,
    clustered: bool = False,
) -> DataFrame:
    """Inner self-join of each (entity, period) with (entity, period - step):
    only consecutive periods pair up, gaps produce no row (which a plain
    ``lag`` would get wrong).

    The current side is already hash-partitioned on (entity, period) by the
    aggregate that produced it, so only the shifted side is shuffled again.
    ``merge_hint`` asks for a sort-merge join at this join only (no session
    setting is changed).

    ``clustered`` is for a copy that ``files.write_clustered`` dealt by the
    entity: the join is by the entity alone, whose periods (a row each) are
    compared within the task, so neither side is shuffled.
    """
    cur = periodic.alias("cur")
    prev = periodic.alias("prev")
    if merge_hint:
        prev = prev.hint("merge")
    now, before = F.col(f"cur.{period}"), F.col(f"prev.{period}")
    # a difference of both sides is no join key
    next_period = now - before == F.lit(step) if clustered else now == before + F.lit(step)
    joined = cur.join(prev, (F.col(f"cur.{entity}") == F.col(f"prev.{entity}")) & next_period, "inner")
    return joined.select(
        F.col(f"cur.{entity}").alias(entity),
        F.col(f"cur.{period}").alias(period),
        as_double(F.col(f"cur.{value}")).alias(value),
        as_double(F.col(f"prev.{value}")).alias(f"prev_{value}"),
        as_double(F.col(f"cur.{value}") - F.col(f"prev.{value}")).alias("delta"),
    )


def month_over_month(df: DataFrame, ts: str = S.INVOICE_DATE) -> DataFrame:
    """Q9: spend change per customer between consecutive calendar months,
    largest increase first."""
    return period_over_period(customer_month_spend(df, ts)).orderBy(
        F.desc("delta"), S.CUSTOMER_ID, "month_index"
    )
