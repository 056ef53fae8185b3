"""Per-year partial results of the sale lines, kept and merged on read.

``refresh`` reduces the year-partitioned copy to small tables with a folder for
each year and writes only the years whose files have changed since the last
time; the queries then merge the years without reading a line again.

=========  ======================================================  =========================
table      a row for each                                          merged by
=========  ======================================================  =========================
spend      (year, country, customer): exact spend, lines, dates    sums, minima, maxima
months     (year, month, country): exact revenue, invoices         (final: a month is in one year)
ids        (year, what, country, bucket): a bitmap of whole ids    bitwise or, then a bit count
texts      (year, invoice) that isn't a whole number's own text    distinct
=========  ======================================================  =========================

Distinct counts don't add up over years, sets do: an id sets its bit in the
bitmap of its bucket (32768 ids, 4 KB), bitmaps of a bucket are or-ed, and the
bits are counted.  Invoices that are no whole numbers are kept as texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import as_double
from tillroll.operators.cleaning import clean
from tillroll.sources import files
from tillroll.sources import schema as S
from tillroll.sources.files import YEAR

INVOICES, CUSTOMERS = "invoice", "customer"
REVENUE_SUM = T.DecimalType(38, 2)
_KEPT = {
    "spend": f"{S.COUNTRY} string, {S.CUSTOMER_ID} bigint, spend decimal(38,2), lines bigint, max_revenue decimal(38,2), first_date timestamp_ntz, last_date timestamp_ntz, {YEAR} int",
    "months": f"month int, {S.COUNTRY} string, revenue decimal(38,2), order_count bigint, {YEAR} int",
    "ids": f"what string, {S.COUNTRY} string, bucket bigint, bits binary, {YEAR} int",
    "texts": f"{S.INVOICE} string, {YEAR} int",
}


def bitmaps(df: DataFrame, group: Iterable[str], id_col: str | Column) -> DataFrame:
    """(group, bucket, bits): the set of a whole-number id in each group.
    Map-side partial bitmaps; a null id is in no set."""
    x = F.col(id_col) if isinstance(id_col, str) else id_col
    ids = df.select(*group, x.cast("long").alias("_id")).where("_id is not null")
    return ids.groupBy(*group, F.bitmap_bucket_number("_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def distinct_of(sets: DataFrame, group: Iterable[str] = (), name: str = "distinct") -> DataFrame:
    """Exact distinct ids per ``group`` of merged bitmaps."""
    merged = sets.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*group).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))


def _whole(invoice: str) -> Column:
    """The invoice as a number, null unless its text is that number's own."""
    number = F.col(invoice).try_cast("bigint")
    return F.when(number.cast("string") == F.col(invoice), number)


def by_invoice(lines: DataFrame) -> DataFrame:
    """Cleaned sale lines with their year, reduced to a row for each year,
    invoice and customer, month and country."""
    return lines.groupBy(YEAR, F.month(S.INVOICE_DATE).alias("month"), S.COUNTRY, S.INVOICE, S.CUSTOMER_ID).agg(
        F.sum(S.REVENUE).alias("rev"), F.count(F.lit(1)).alias("n"), F.max(S.REVENUE).alias("max_rev"),
        F.min(S.INVOICE_DATE).alias("first"), F.max(S.INVOICE_DATE).alias("last"),
    )


def partials(invoices: DataFrame) -> dict[str, DataFrame]:
    """The kept tables, from ``by_invoice``'s rows."""
    spend = invoices.groupBy(YEAR, S.COUNTRY, S.CUSTOMER_ID).agg(
        F.sum("rev").cast(REVENUE_SUM).alias("spend"), F.sum("n").alias("lines"), F.max("max_rev").cast(REVENUE_SUM).alias("max_revenue"),
        F.min("first").alias("first_date"), F.max("last").alias("last_date"),
    )
    per_invoice = invoices.groupBy(YEAR, "month", S.COUNTRY, S.INVOICE).agg(F.sum("rev").alias("rev"))
    months = per_invoice.groupBy(YEAR, "month", S.COUNTRY).agg(F.sum("rev").cast(REVENUE_SUM).alias("revenue"), F.count(S.INVOICE).alias("order_count"))
    nowhere = F.lit(None).cast("string").alias(S.COUNTRY)
    ids = bitmaps(invoices, [YEAR], _whole(S.INVOICE)).select(YEAR, F.lit(INVOICES).alias("what"), nowhere, "bucket", "bits").unionByName(
        bitmaps(invoices, [YEAR, S.COUNTRY], S.CUSTOMER_ID).select(YEAR, F.lit(CUSTOMERS).alias("what"), S.COUNTRY, "bucket", "bits")
    )
    texts = invoices.where(_whole(S.INVOICE).isNull()).select(YEAR, S.INVOICE).distinct()
    return {"spend": spend, "months": months, "ids": ids, "texts": texts}


def _stamps(spark: SparkSession, copy: str) -> dict[int, str]:
    """What each year's files are: their names, sizes and times, as one hash.
    Reads no column but the files' own."""
    rows = spark.read.parquet(copy).select(YEAR, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    one = F.xxhash64("file_path", "file_size", F.col("file_modification_time").cast("string"))
    each = rows.select(YEAR, one.alias("h")).distinct().groupBy(YEAR).agg(F.hex(F.bit_xor("h")).alias("h"), F.count(F.lit(1)).alias("n"))
    return {r[YEAR]: f"{r['h']}-{r['n']}" for r in each.collect()}


def refresh(spark: SparkSession, copy: str, kept: str) -> list[int]:
    """Brings the kept tables up to date with the copy; the years written.

    A year's folders are replaced by Spark's dynamic partition overwrite and
    its stamp is written after them, so a run that ends early is repeated for
    the years it hadn't finished."""
    now, at = _stamps(spark, copy), f"{kept}/stamps"
    old = {}
    if files.exists(spark, at):
        old = {int(k): v for k, v in json.loads(spark.read.text(at, wholetext=True).first()[0]).items()}
    changed, gone = sorted(y for y in now if now[y] != old.get(y)), sorted(set(old) - set(now))
    if changed:
        lines = clean(files.read_sales(spark, copy, years=changed, keep_year=True))
        invoices = files.materialize(by_invoice(lines), "invoices")  # the lines are read once
        for name, df in partials(invoices).items():
            _drop_years(spark, f"{kept}/{name}", changed)  # a year may have no row now
            out = df.select(*[c for c in df.columns if c != YEAR], YEAR).hint("rebalance", YEAR)
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(f"{kept}/{name}")
        files.remove(invoices)
    for name in _KEPT:
        _drop_years(spark, f"{kept}/{name}", gone)
    if changed or gone:
        spark.createDataFrame([(json.dumps({str(y): s for y, s in now.items()}),)], "value string").coalesce(1).write.mode("overwrite").text(at)
    return changed


def _drop_years(spark: SparkSession, table: str, years: Iterable[int]) -> None:
    for y in years:
        files.delete(spark, f"{table}/{YEAR}={y}")


def read_kept(spark: SparkSession, kept: str, name: str) -> DataFrame:
    return spark.read.schema(_KEPT[name]).parquet(f"{kept}/{name}")


# ---- the queries over kept tables ------------------------------------------


def summary(spark: SparkSession, kept: str) -> DataFrame:
    """Q2 from the kept tables: one row."""
    ids, texts = read_kept(spark, kept, "ids"), read_kept(spark, kept, "texts")
    money = read_kept(spark, kept, "spend").agg(
        F.sum("spend").alias("total"), F.max("max_revenue").alias("max_rev"), F.min("first_date").alias("min_invoice_date"), F.max("last_date").alias("max_invoice_date")
    )
    whole = distinct_of(ids.where(F.col("what") == INVOICES)).scalar()
    customers = distinct_of(ids.where(F.col("what") == CUSTOMERS)).scalar()
    named = texts.groupBy(S.INVOICE).agg(F.lit(1).alias("one"))
    other, null_invoice = named.agg(F.count(S.INVOICE)).scalar(), named.agg(F.count(F.lit(1)) - F.count(S.INVOICE)).scalar()
    invoices = whole + other
    return money.select(
        as_double("total").alias("total_revenue"), invoices.alias("distinct_invoices"), customers.alias("distinct_customers"),
        as_double("max_rev").alias("max_line_revenue"), "min_invoice_date", "max_invoice_date",
        F.try_divide(as_double("total"), (invoices + null_invoice).cast("double")).alias("avg_order_value"),
    )


def revenue_by_month(spark: SparkSession, kept: str) -> DataFrame:
    """Q3 from the kept tables."""
    out = read_kept(spark, kept, "months").select(S.COUNTRY, YEAR, "month", as_double("revenue").alias("revenue"), "order_count")
    return out.orderBy(F.desc("revenue"), *[F.asc_nulls_first(c) for c in (S.COUNTRY, YEAR, "month")])


def revenue_by_region(spark: SparkSession, kept: str, lookup: DataFrame) -> DataFrame:
    """Q8 from the kept tables."""
    region = lookup.select(S.COUNTRY, "region")
    money = read_kept(spark, kept, "spend").groupBy(S.COUNTRY).agg(F.sum("spend").alias("spend")).join(region, S.COUNTRY, "left")
    money = money.groupBy("region").agg(as_double(F.sum("spend")).alias("revenue"))
    sets = read_kept(spark, kept, "ids").where(F.col("what") == CUSTOMERS).join(region, S.COUNTRY, "left")
    people = distinct_of(sets, ["region"], "distinct_customers").withColumnRenamed("region", "of")
    return money.join(people, money.region.eqNullSafe(people.of)).drop("of").orderBy(F.desc("revenue"), F.asc_nulls_first("region"))


def customer_totals(spark: SparkSession, kept: str) -> DataFrame:
    """Exact spend per customer over all years."""
    return read_kept(spark, kept, "spend").groupBy(S.CUSTOMER_ID).agg(F.sum("spend").alias("total_spend"))
