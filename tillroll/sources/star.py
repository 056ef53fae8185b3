"""The sale-line fact table derived from the TPC-H-like star tables.

Mapping (one sale line per ``lineitem`` row):

* invoice      -- ``o_orderkey`` as text, prefixed ``C`` (cancelled) when the order status is ``P``
* stock_code   -- ``l_partkey``; description -- ``p_name``
* quantity     -- ``l_quantity``, negated for returned lines (``l_returnflag = 'R'``)
* invoice_date -- ``o_orderdate``; price -- ``p_retailprice`` as ``decimal(12,2)``
* customer_id  -- ``c_custkey``, NULL (unknown customer) when ``c_acctbal < 0``
* country      -- ``n_name``

Join order is chosen for the large case: customer x nation, then orders x
customers on the customer key, then lineitem x orders on the order key and
x part on the part key.  Only nation (25 rows) has a broadcast hint; the
other sides are broadcast when Spark has measured them to be small enough,
and sort-merge joined beyond that, with AQE splitting skewed partitions.
Computed columns come after the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import schema as S

# Fixed values of the mapping above.
CANCELLED_ORDER_STATUS = "P"
CANCEL_PREFIX = "C"
RETURN_FLAG = "R"


# The star tables' columns this mapping reads, with their types.
STAR_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One star table.  For the tables of the mapping the reader gets the
    declared columns: no footer-reading job to infer a schema, and only
    those columns are ever read."""
    reader = spark.read
    if name in STAR_COLUMNS:
        reader = reader.schema(STAR_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _invoice(orderkey: F.Column, status: F.Column) -> F.Column:
    prefix = F.when(status == F.lit(CANCELLED_ORDER_STATUS), F.lit(CANCEL_PREFIX)).otherwise(F.lit(""))
    return F.concat(prefix, orderkey.cast("string"))


def sales_from_star(spark: SparkSession, sf_dir: str, valid: bool = False) -> DataFrame:
    """Raw (uncleaned) sale lines with the columns of ``SALES_SCHEMA``.

    ``valid`` is for callers that clean the lines anyway: filters on the
    star tables' own columns, which cleaning implies, are added so that they
    reach the Parquet scans.  The cleaned rows are the same."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag"
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    if valid:  # implied by the cleaning rules, in the tables' own columns
        flag = F.coalesce("l_returnflag", F.lit(""))
        kept = (F.col("l_quantity") >= 1) & (flag != RETURN_FLAG) | (F.col("l_quantity") <= -1) & (flag == RETURN_FLAG)
        bought = F.col("l_quantity")
        lineitem = lineitem.where((bought >= 1) | (bought <= -1)).where(kept)
        orders = orders.where(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != CANCELLED_ORDER_STATUS))
        customer = customer.where(F.col("c_acctbal").isNull() | (F.col("c_acctbal") >= 0))
        part = part.where(F.col("p_retailprice") > 0)
    # nation has 25 rows; for the other sides Spark goes by measured bytes
    customer_side = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "inner").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("bigint")).otherwise(F.col("c_custkey")).alias(S.CUSTOMER_ID),
        F.col("n_name").alias(S.COUNTRY),
    )
    order_side = orders.join(customer_side, orders.o_custkey == customer_side.c_custkey, "inner").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias(S.INVOICE_DATE), S.CUSTOMER_ID, S.COUNTRY
    )
    qty = F.col("l_quantity").cast("int")
    lines = lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") == F.lit(RETURN_FLAG), -qty).otherwise(qty).alias(S.QUANTITY),
    )
    return (
        lines.join(order_side, lines.l_orderkey == order_side.o_orderkey, "inner")
        .join(part, F.col("l_partkey") == part.p_partkey, "inner")
        .select(
            _invoice(F.col("o_orderkey"), F.col("o_orderstatus")).alias(S.INVOICE),
            F.col("l_partkey").cast("string").alias(S.STOCK_CODE),
            F.col("p_name").alias(S.DESCRIPTION),
            F.col(S.QUANTITY),
            F.col(S.INVOICE_DATE),
            F.col("p_retailprice").cast(S.MONEY).alias(S.PRICE),
            F.col(S.CUSTOMER_ID),
            F.col(S.COUNTRY),
        )
    )


def region_lookup_from_star(spark: SparkSession, sf_dir: str, exclude_regionkeys=()) -> DataFrame:
    """``(country, region)`` pairs from nation x region.

    Nations of ``exclude_regionkeys`` are left out on request, so that there
    are countries without a lookup entry.
    """
    nation = read_table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    if exclude_regionkeys:
        region = region.where(~F.col("r_regionkey").isin(list(exclude_regionkeys)))
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_name").alias(S.COUNTRY), F.col("r_name").alias("region")
    )
