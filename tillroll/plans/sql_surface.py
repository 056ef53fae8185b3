"""The same queries as Spark SQL text over registered views.

``register_views`` names the raw sale lines ``tillroll_raw``, defines ``tillroll_sales`` as a
SQL view over it (cleaning predicate + revenue) and names the lookup
``tillroll_country_region``; each ``sql_qNN`` is SQL text over them (CTEs, scalar
subqueries, window functions, hints): one statement, Q10 two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.cleaning import STAR_END, STAR_START
from tillroll.sources import files
from tillroll.sources.star import region_lookup_from_star, sales_from_star


CLEAN_PREDICATE = """
quantity > 0 AND price > 0 AND customer_id IS NOT NULL AND invoice NOT LIKE '{prefix}%'
AND invoice_date IS NOT NULL"""
WINDOW = " AND invoice_date BETWEEN TIMESTAMP_NTZ '{start}' AND TIMESTAMP_NTZ '{end}'"


def register_views(
    spark: SparkSession,
    sf_dir: str,
    raw: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    cancel_prefix: str = "C",
) -> None:
    """Temp views: ``raw`` (the uncleaned sale lines: derived from the star
    tables, or any ``raw`` frame such as a CSV or Parquet copy), ``sales``
    (a SQL view over ``raw``: the cleaning predicate plus revenue) and
    ``country_region``."""
    (raw if raw is not None else sales_from_star(spark, sf_dir, valid=True)).createOrReplaceTempView("tillroll_raw")
    predicate = CLEAN_PREDICATE.format(prefix=cancel_prefix)
    if start and end:
        predicate += WINDOW.format(start=start, end=end)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW tillroll_sales AS SELECT *, quantity * price AS revenue FROM tillroll_raw WHERE {predicate}")
    region_lookup_from_star(spark, sf_dir).createOrReplaceTempView("tillroll_country_region")


SQL_Q01 = """
SELECT invoice, stock_code, description, quantity, invoice_date, CAST(price AS DOUBLE) AS price,
       customer_id, country, CAST(quantity * price AS DOUBLE) AS revenue
FROM tillroll_raw
WHERE """ + CLEAN_PREDICATE.format(prefix="C") + WINDOW.format(start=STAR_START, end=STAR_END)

# One aggregate per invoice and customer, and one over those rows.
SQL_Q02 = """
WITH lines AS (
    SELECT invoice, customer_id, sum(revenue) AS rev, max(revenue) AS max_rev,
           min(invoice_date) AS first_date, max(invoice_date) AS last_date
    FROM tillroll_sales GROUP BY invoice, customer_id
),
one AS (
    SELECT sum(rev) AS total, count(DISTINCT invoice) AS distinct_invoices,
           count(DISTINCT customer_id) AS distinct_customers, max(max_rev) AS max_rev,
           min(first_date) AS min_invoice_date, max(last_date) AS max_invoice_date,
           coalesce(max(CAST(invoice IS NULL AS INT)), 0) AS null_invoice
    FROM lines
)
SELECT CAST(total AS DOUBLE) AS total_revenue, distinct_invoices, distinct_customers,
       CAST(max_rev AS DOUBLE) AS max_line_revenue, min_invoice_date, max_invoice_date,
       try_divide(CAST(total AS DOUBLE), CAST(distinct_invoices + null_invoice AS DOUBLE)) AS avg_order_value
FROM one"""

SQL_Q03 = """
SELECT country, year(invoice_date) AS year, month(invoice_date) AS month,
       CAST(sum(revenue) AS DOUBLE) AS revenue, count(DISTINCT invoice) AS order_count
FROM tillroll_sales
GROUP BY country, year(invoice_date), month(invoice_date)
ORDER BY revenue DESC, country, year, month"""

SQL_Q04 = """
SELECT stock_code, description, CAST(rev AS DOUBLE) AS revenue, units_sold
FROM (
    SELECT stock_code, description, sum(revenue) AS rev, CAST(sum(quantity) AS BIGINT) AS units_sold
    FROM tillroll_sales GROUP BY stock_code, description
)
ORDER BY rev DESC, stock_code, description
LIMIT 10"""

SQL_Q05 = """
WITH monthly AS (
    SELECT year(invoice_date) AS year, month(invoice_date) AS month, sum(revenue) AS revenue
    FROM tillroll_sales GROUP BY year(invoice_date), month(invoice_date)
)
SELECT year, month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(sum(revenue) OVER (ORDER BY year, month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
           AS cumulative_revenue,
       CAST(sum(revenue) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
           / CAST(count(revenue) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
           AS moving_avg_3mo
FROM monthly
ORDER BY year, month"""

SQL_Q06 = """
WITH totals AS (
    SELECT country, customer_id, sum(revenue) AS total FROM tillroll_sales GROUP BY country, customer_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY country ORDER BY total DESC, customer_id) AS rank_in_country
    FROM totals
)
SELECT country, customer_id, CAST(total AS DOUBLE) AS total_spend, rank_in_country
FROM ranked
WHERE rank_in_country <= 5
ORDER BY country, rank_in_country"""

# Scalar subqueries in the select list and in WHERE: Spark plans the two
# identical subqueries once and reads the per-customer shuffle of the main
# query (ReusedSubquery, ReusedExchange).
SQL_Q07 = """
WITH totals AS (SELECT customer_id, sum(revenue) AS total FROM tillroll_sales GROUP BY customer_id)
SELECT customer_id, CAST(total AS DOUBLE) AS total_spend,
       (SELECT try_divide(CAST(sum(total) AS DOUBLE), CAST(count(total) AS DOUBLE)) FROM totals) AS avg_spend_baseline
FROM totals
WHERE CAST(total AS DOUBLE) > (SELECT try_divide(CAST(sum(total) AS DOUBLE), CAST(count(total) AS DOUBLE)) FROM totals)
ORDER BY total_spend DESC, customer_id"""

SQL_Q08 = """
SELECT cr.region AS region, CAST(sum(s.revenue) AS DOUBLE) AS revenue,
       count(DISTINCT s.customer_id) AS distinct_customers
FROM tillroll_sales s LEFT JOIN tillroll_country_region cr ON s.country = cr.country
GROUP BY cr.region
ORDER BY revenue DESC, region"""

SQL_Q09 = """
WITH monthly AS (
    SELECT customer_id, year(invoice_date) * 12 + month(invoice_date) AS month_index, sum(revenue) AS spend
    FROM tillroll_sales GROUP BY customer_id, year(invoice_date) * 12 + month(invoice_date)
)
SELECT /*+ MERGE(prev) */
       cur.customer_id, cur.month_index, CAST(cur.spend AS DOUBLE) AS month_spend,
       CAST(prev.spend AS DOUBLE) AS prev_month_spend, CAST(cur.spend - prev.spend AS DOUBLE) AS delta
FROM monthly cur JOIN monthly prev
  ON cur.customer_id = prev.customer_id AND cur.month_index = prev.month_index + 1
ORDER BY delta DESC, cur.customer_id, cur.month_index"""


def _rfm_base_sql() -> str:
    return """
WITH per_customer AS (
    SELECT customer_id, max(invoice_date) AS last_date, count(DISTINCT invoice) AS frequency,
           sum(revenue) AS monetary
    FROM tillroll_sales GROUP BY customer_id
)
SELECT customer_id,
       datediff(to_date((SELECT max(struct(last_date, frequency, monetary)).last_date FROM per_customer)), to_date(last_date)) AS recency_days,
       frequency, monetary
FROM per_customer"""


# The three orderings one after another as (ordering, key, customer): every key
# counts down to the best score's end, so all are ascending.  Dealt by ranges
# in one exchange, sorted in tasks and written once with each row's place; the
# first ordering's rows carry the metrics.
SQL_Q10_DEALT = """
INSERT OVERWRITE DIRECTORY '{path}' USING parquet
WITH rfm AS (""" + _rfm_base_sql() + """
),
orderings AS (
    SELECT /*+ REPARTITION_BY_RANGE(o, k, customer_id) */ o, k, customer_id,
           if(o = 0, recency_days, NULL) AS recency_days, if(o = 0, frequency, NULL) AS frequency, if(o = 0, monetary, NULL) AS monetary
    FROM (
        SELECT *, inline(array(struct(0 AS o, CAST(recency_days AS DECIMAL(38, 2)) AS k),
                               struct(1 AS o, CAST(-frequency AS DECIMAL(38, 2)) AS k),
                               struct(2 AS o, CAST(-monetary AS DECIMAL(38, 2)) AS k)))
        FROM rfm
    )
    SORT BY o, k, customer_id
)
SELECT *, monotonically_increasing_id() AS place FROM orderings"""

# A task's places are task << 33 | row.  Tile j of an ordering of n rows ends at
# row j * q + min(j, r) with q = n div 5, r = n mod 5; the rows at those ends
# are the cuts, and a row's tile is 1 + the number of cuts before it.
SQL_Q10 = """
WITH dealt AS (SELECT * FROM tillroll_rfm_dealt),
sizes AS (SELECT shiftright(place, 33) AS task, count(*) AS n FROM dealt GROUP BY shiftright(place, 33)),
placed AS (
    SELECT task, n, sum(n) OVER (ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to,
           sum(n) OVER (ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) DIV 3 AS each
    FROM sizes
),
ends AS (
    SELECT task, n, up_to, o * each + j * (each DIV 5) + least(j, each % 5) AS rank
    FROM placed LATERAL VIEW explode(array(0, 1, 2)) AS o LATERAL VIEW explode(array(1, 2, 3, 4)) AS j
),
wanted AS (
    SELECT DISTINCT shiftleft(task, 33) + rank - (up_to - n) - 1 AS place FROM ends WHERE rank <= up_to AND rank > up_to - n
),
cuts AS (
    SELECT collect_list(struct(o, k, customer_id AS t)) AS rows
    FROM (SELECT /*+ BROADCAST(wanted) */ dealt.* FROM dealt JOIN wanted ON dealt.place = wanted.place)
),
tiled AS (
    SELECT customer_id, recency_days, frequency, monetary, (SELECT rows FROM cuts) AS cut_rows FROM dealt WHERE o = 0
),
scored AS (
    SELECT customer_id, recency_days, frequency, monetary,
           5 - size(filter(cut_rows, c -> c.o = 0 AND (c.k < recency_days OR c.k = recency_days AND c.t < customer_id))) AS r_score,
           5 - size(filter(cut_rows, c -> c.o = 1 AND (c.k < -frequency OR c.k = -frequency AND c.t < customer_id))) AS f_score,
           5 - size(filter(cut_rows, c -> c.o = 2 AND (c.k < -monetary OR c.k = -monetary AND c.t < customer_id))) AS m_score
    FROM tiled
)
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
       CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
            WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal'
            WHEN r_score <= 2 AND f_score >= 3 THEN 'At-Risk'
            WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
            ELSE 'Other' END AS segment
FROM scored"""


def _sql(text: str, views: Callable[[SparkSession, str], None] = register_views):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views(spark, sf_dir)
        return spark.sql(text)

    return run


def sql_q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM segments, two statements: the first writes the dealt orderings to
    the session's shared folder, the second reads them."""
    register_views(spark, sf_dir)
    path = files.fresh_path(spark, "rfm-dealt")
    spark.sql(SQL_Q10_DEALT.format(path=path))
    spark.sql(f"CREATE OR REPLACE TEMP VIEW tillroll_rfm_dealt AS SELECT * FROM parquet.`{path}`")
    return spark.sql(SQL_Q10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "sql_q01": _sql(SQL_Q01),
        "sql_q02": _sql(SQL_Q02),
        "sql_q03": _sql(SQL_Q03),
        "sql_q04": _sql(SQL_Q04),
        "sql_q05": _sql(SQL_Q05),
        "sql_q06": _sql(SQL_Q06),
        "sql_q07": _sql(SQL_Q07),
        "sql_q08": _sql(SQL_Q08),
        "sql_q09": _sql(SQL_Q09),
        "sql_q10": sql_q10,
    }
