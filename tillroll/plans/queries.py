"""The ten retail queries (and their parts) as lazy DataFrames over the
star tables in ``sf_dir``.  Each function takes ``(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import as_double
from tillroll.operators import aggregates, compare, enrich, kept, ranking, rfm, trend
from tillroll.operators.cleaning import STAR_END, STAR_START, clean
from tillroll.sources import calendar, files, lines
from tillroll.sources import schema as S
from tillroll.sources.star import region_lookup_from_star, sales_from_star


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sales_from_star(spark, sf_dir, valid=True))


# ---- the queries over any cleaned sale-line frame (``s``) -----------------


def q01_form(s: DataFrame) -> DataFrame:
    return s.select(
        *[as_double(c).alias(c) if c == S.PRICE else F.col(c) for c in S.SALES_COLUMNS],
        as_double(S.REVENUE).alias(S.REVENUE),
    )


def q03_form(s: DataFrame) -> DataFrame:
    return aggregates.revenue_by(
        s, [S.COUNTRY, F.year(S.INVOICE_DATE).alias("year"), F.month(S.INVOICE_DATE).alias("month")]
    )


def q04_form(s: DataFrame, n: int = 10) -> DataFrame:
    per_product = s.groupBy(S.STOCK_CODE, S.DESCRIPTION).agg(
        F.sum(S.REVENUE).alias("_rev"),
        F.sum(S.QUANTITY).cast("bigint").alias("units_sold"),
    )
    top = ranking.top_n(
        per_product, n, [F.desc("_rev"), F.asc_nulls_first(S.STOCK_CODE), F.asc_nulls_first(S.DESCRIPTION)]
    )
    return top.select(S.STOCK_CODE, S.DESCRIPTION, as_double("_rev").alias("revenue"), "units_sold")


def q06_form(s: DataFrame, n: int = 5) -> DataFrame:
    totals = aggregates.customer_totals(s, [S.COUNTRY, S.CUSTOMER_ID])
    ranked = ranking.top_n_per_group(
        totals, [S.COUNTRY], [F.desc("total_spend"), F.asc(S.CUSTOMER_ID)], n, rank_name="rank_in_country"
    )
    return ranked.select(
        S.COUNTRY, S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"), "rank_in_country"
    ).orderBy(S.COUNTRY, "rank_in_country")


def q08_form(s: DataFrame, lookup: DataFrame, default: str | None = None) -> DataFrame:
    return enrich.revenue_by_region(s, lookup, default=default)


UNMAPPED_REGIONKEYS = (4,)

# Q1..Q10 as functions of (cleaned sales, region lookup).
FORMS = {
    "q1": lambda s, lookup: q01_form(s),
    "q2": lambda s, lookup: aggregates.summary(s),
    "q3": lambda s, lookup: q03_form(s),
    "q4": lambda s, lookup: q04_form(s),
    "q5": lambda s, lookup: trend.monthly_trend(s),
    "q6": lambda s, lookup: q06_form(s),
    "q7": lambda s, lookup: compare.above_mean_customers(s),
    "q8": q08_form,
    "q9": lambda s, lookup: trend.month_over_month(s),
    "q10": lambda s, lookup: rfm.rfm_segments(s),
}


# ---- the registered queries over the star tables --------------------------


def q01_clean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid sale lines of a date window with revenue; money as double."""
    return q01_form(clean(sales_from_star(spark, sf_dir, valid=True), STAR_START, STAR_END))


def q02_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.summary(cleaned(spark, sf_dir))


def q03_revenue_by_country_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q03_form(cleaned(spark, sf_dir))


def q04_top_products(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    return q04_form(cleaned(spark, sf_dir), n)


def q05_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.monthly_trend(cleaned(spark, sf_dir))


def q06_top_customers_per_country(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    return q06_form(cleaned(spark, sf_dir), n)


def q07_above_mean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.above_mean_customers(cleaned(spark, sf_dir))


def q08_region_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q08_form(cleaned(spark, sf_dir), region_lookup_from_star(spark, sf_dir))


def q08_region_default_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 over a lookup without one region: unmapped countries are labelled
    ``Unknown`` instead of NULL."""
    lookup = region_lookup_from_star(spark, sf_dir, exclude_regionkeys=UNMAPPED_REGIONKEYS)
    return q08_form(cleaned(spark, sf_dir), lookup, default="Unknown")


def q09_month_over_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.month_over_month(cleaned(spark, sf_dir))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_segments(cleaned(spark, sf_dir))


def q10_rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


def q10_rfm_segments_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as Q10, which has one algorithm for every size."""
    return _segments(spark, sf_dir)


def q10_segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_summary(_segments(spark, sf_dir))


def q10_segment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_sizes(_segments(spark, sf_dir))


def q10_top_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.top_per_segment(_segments(spark, sf_dir))


def customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per customer (the shared intermediate of Q6, Q7 and Q10)."""
    t = aggregates.customer_totals(cleaned(spark, sf_dir))
    return t.select(S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"))


def invoice_totals_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.invoice_totals_mean(cleaned(spark, sf_dir))


def global_ntile_monetary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decile of every customer by spend, largest first."""
    t = aggregates.customer_totals(cleaned(spark, sf_dir))
    tiled = ranking.global_ntile(t, 10, "total_spend", S.CUSTOMER_ID, ascending=False, out="decile")
    return tiled.select(S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"), "decile")


def csv_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sale lines written as CSV (shared folder), read back with the
    explicit schema, then Q3: the CSV source gives the same rows."""
    path = files.fresh_path(spark, "sales-csv")
    files.write_sales_csv(sales_from_star(spark, sf_dir), path)
    return q03_form(clean(files.read_sales(spark, path, fmt="csv")))


PRUNED_YEARS = (1996, 1997)


def partitioned_write_pruned_read(spark: SparkSession, sf_dir: str, years=PRUNED_YEARS) -> DataFrame:
    """Raw sale lines written ``year=``-partitioned (shared folder); Q3 over
    a read that names only ``years``, so other directories are pruned."""
    path = prepare_sales(spark, sf_dir)
    return q03_form(clean(files.read_sales(spark, path, fmt="parquet", years=years)))


def prepare_sales(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    """Denormalise the star tables once into the ``year``-partitioned copy
    (shared folder); returns its location.  Later queries over the copy
    are single-table scans with no join shuffles."""
    path = path or files.fresh_path(spark, "sales-by-year")
    files.write_by_year(sales_from_star(spark, sf_dir), path)
    return path


def cleaned_from_copy(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Cleaned sale lines from the year-partitioned copy.  A date window
    implies a year range: closed, its directories alone are listed; open on a
    side, it is a filter on the partition column."""
    since, until = (int(d[:4]) if d else None for d in (start, end))
    years = range(since, until + 1) if start and end else None
    return clean(files.read_sales(spark, path, fmt="parquet", years=years, since=since, until=until), start=start, end=end)


# ---- the same queries by other means --------------------------------------

def q09_clustered_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 (unordered) over a copy of the monthly spends that is clustered by
    customer, in as many buckets as shuffles have partitions: a sort-merge join
    with no exchange."""
    path, buckets = files.fresh_path(spark, "months-by-customer"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    months = trend.customer_month_spend(cleaned(spark, sf_dir))
    files.write_clustered(months, path, S.CUSTOMER_ID, buckets, ["month_index"])
    copy = files.read_clustered(spark, path, months.schema, S.CUSTOMER_ID, buckets, ["month_index"])
    return trend.period_over_period(copy, clustered=True)


def calendar_pruned_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 over the leap years, which a join with the calendar finds while the
    query runs: other years' directories aren't read."""
    path = prepare_sales(spark, sf_dir)
    sales = files.read_sales(spark, path, keep_year=True)
    leap = calendar.years(spark, 1900, 2100).where("days = 366")
    return q03_form(clean(calendar.in_years(sales, leap)))


def running_invoice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice with its total, in the order of date and invoice, the
    total so far and the mean of the last three."""
    per_invoice = cleaned(spark, sf_dir).groupBy(S.INVOICE).agg(F.min(S.INVOICE_DATE).alias(S.INVOICE_DATE), F.sum(S.REVENUE).alias("total"))
    out = trend.running_stats_by_range(per_invoice, "total", [S.INVOICE_DATE, S.INVOICE], 3, "cumulative_total", "moving_avg_3")
    return out.select(S.INVOICE, S.INVOICE_DATE, as_double("total").alias("total"), "cumulative_total", "moving_avg_3")


def _kept(spark: SparkSession, sf_dir: str) -> str:
    """Kept tables of a copy, brought up to date."""
    path = files.fresh_path(spark, "kept")
    kept.refresh(spark, prepare_sales(spark, sf_dir), path)
    return path


def kept_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 from per-year sums and bitmaps."""
    return kept.summary(spark, _kept(spark, sf_dir))


def kept_revenue_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 from per-year tables."""
    return kept.revenue_by_month(spark, _kept(spark, sf_dir))


def kept_revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 from per-year sums and bitmaps."""
    return kept.revenue_by_region(spark, _kept(spark, sf_dir), region_lookup_from_star(spark, sf_dir))


def kept_customer_lists(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """Two lists from one kept result: the ``n`` customers with the largest
    spend, and all above the mean.  The sale lines were read once, for the
    kept tables."""
    totals = kept.customer_totals(spark, _kept(spark, sf_dir))
    top = ranking.top_n(totals, n, [F.desc("total_spend"), F.asc(S.CUSTOMER_ID)]).select(F.lit("top").alias("list"), S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"))
    above = compare.above_mean(totals).select(F.lit("above_mean").alias("list"), S.CUSTOMER_ID, as_double("total_spend").alias("total_spend"))
    return top.unionByName(above)


def revenue_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and lines by the product's brand, looked up by stock code in a
    table that may be too large to broadcast."""
    brands = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet").select(F.col("p_partkey").cast("string").alias(S.STOCK_CODE), F.col("p_brand").alias("brand"))
    sold = cleaned(spark, sf_dir).select(S.STOCK_CODE, S.REVENUE)
    joined = enrich.hot_lookup_join(sold, brands, S.STOCK_CODE, "brand", default="Unknown")
    return joined.groupBy("brand").agg(as_double(F.sum(S.REVENUE)).alias("revenue"), F.count(F.lit(1)).alias("lines"))


#: Columns made unreadable in damaged lines, by way; the way after them adds fields.
DAMAGED = (S.QUANTITY, S.INVOICE_DATE, S.PRICE)


def _damaged(name: str, way: Column) -> Column:
    return F.when(way == DAMAGED.index(name), F.lit("?")).otherwise(F.col(name)).alias(name) if name in DAMAGED else F.col(name)


def text_lines_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sale lines as text, those of cancelled invoices damaged in one
    of four ways, read back: lines and revenue by reason of rejection."""
    sales = sales_from_star(spark, sf_dir)
    values = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == S.INVOICE_DATE else F.col(c).cast("string").alias(c) for c in S.SALES_COLUMNS]
    way = F.when(F.col(S.INVOICE).startswith("C"), F.length(S.STOCK_CODE) % 4).otherwise(-1)
    line = F.concat(F.to_csv(F.struct(*S.SALES_COLUMNS), {"nullValue": "\\N"}), F.when(F.col("_way") == 3, F.lit(",one,more")).otherwise(""))
    path = files.fresh_path(spark, "sale-lines")
    text = sales.select(*values, way.alias("_way")).select(*[_damaged(c, F.col("_way")) for c in S.SALES_COLUMNS], "_way").select(line.alias("value"))
    text.write.text(path)
    read = lines.read_lines(spark, path)
    good, bad = files.fresh_path(spark, "lines-good"), files.fresh_path(spark, "lines-bad")
    lines.write_split(read, good, bad)
    kept_lines = spark.read.schema(lines.accepted(read).schema).parquet(good)
    money = as_double(F.sum(F.col(S.QUANTITY) * F.col(S.PRICE).cast(S.MONEY)))
    taken = kept_lines.agg(F.lit("none").alias("reason"), F.count(F.lit(1)).alias("lines"), money.alias("revenue"))
    dropped = spark.read.schema(lines.rejected(read).schema).parquet(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.lit(None).cast("double").alias("revenue"))
    return taken.unionByName(dropped)
