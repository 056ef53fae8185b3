"""Independent DuckDB formulations of every registered query.

Written against the raw star tables (views ``lineitem orders customer part
nation region``) with the same mapping and parameters as the Spark code,
but without any of its operators: plain SQL, the engine's own window and
distinct implementations.  Money is summed as DECIMAL and converted to
DOUBLE once, as in the Spark code, so values match to the last bit.
"""

from __future__ import annotations

# Fixed values shared with the Spark side: the date window of Q1 and the
# region left out of the lookup with a default label.
START = "1995-01-01 00:00:00"
END = "2000-12-31 23:59:59"
EXCLUDED_REGIONKEY = 4

RAW_SALES = """
raw_sales AS (
    SELECT concat(CASE WHEN o.o_orderstatus = 'P' THEN 'C' ELSE '' END, CAST(o.o_orderkey AS VARCHAR)) AS invoice,
           CAST(l.l_partkey AS VARCHAR) AS stock_code,
           p.p_name AS description,
           CASE WHEN l.l_returnflag = 'R' THEN -CAST(trunc(l.l_quantity) AS INTEGER)
                ELSE CAST(trunc(l.l_quantity) AS INTEGER) END AS quantity,
           o.o_orderdate AS invoice_date,
           CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
           CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_custkey END AS customer_id,
           n.n_name AS country
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _clean_from(source: str) -> str:
    return f"""
sales AS (
    SELECT *, quantity * price AS revenue
    FROM {source}
    WHERE quantity > 0 AND price > 0 AND customer_id IS NOT NULL
      AND NOT (invoice LIKE 'C%')
      AND invoice_date IS NOT NULL
)"""


SALES = RAW_SALES + "," + _clean_from("raw_sales")

LOOKUP = """
country_region AS (
    SELECT n.n_name AS country, r.r_name AS region
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""
PART_LOOKUP = LOOKUP.replace("r.r_regionkey\n)", f"r.r_regionkey\n    WHERE r.r_regionkey <> {EXCLUDED_REGIONKEY}\n)")

RFM = """
per_customer AS (
    SELECT customer_id, max(invoice_date) AS last_date,
           count(DISTINCT invoice) AS frequency, sum(revenue) AS monetary
    FROM sales GROUP BY customer_id
),
rfm AS (
    SELECT customer_id,
           CAST(date_diff('day', CAST(last_date AS DATE),
                          CAST((SELECT max(last_date) FROM per_customer) AS DATE)) AS INTEGER) AS recency_days,
           frequency, monetary
    FROM per_customer
),
segments AS (
    SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, monetary AS monetary_exact,
           r_score, f_score, m_score,
           CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'At-Risk'
                WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
                ELSE 'Other' END AS segment
    FROM (
        SELECT *,
               CAST(6 - ntile(5) OVER (ORDER BY recency_days ASC NULLS FIRST, customer_id ASC) AS INTEGER) AS r_score,
               CAST(6 - ntile(5) OVER (ORDER BY frequency DESC NULLS LAST, customer_id ASC) AS INTEGER) AS f_score,
               CAST(6 - ntile(5) OVER (ORDER BY monetary DESC NULLS LAST, customer_id ASC) AS INTEGER) AS m_score
        FROM rfm
    )
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


Q01 = _with(SALES) + """
SELECT invoice, stock_code, description, quantity, invoice_date, CAST(price AS DOUBLE) AS price,
       customer_id, country, CAST(revenue AS DOUBLE) AS revenue
FROM sales
WHERE invoice_date BETWEEN TIMESTAMP '""" + START + """' AND TIMESTAMP '""" + END + """'"""

Q02 = _with(SALES) + """
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT invoice) AS distinct_invoices,
       count(DISTINCT customer_id) AS distinct_customers,
       CAST(max(revenue) AS DOUBLE) AS max_line_revenue,
       min(invoice_date) AS min_invoice_date,
       max(invoice_date) AS max_invoice_date,
       (SELECT CAST(sum(t) AS DOUBLE) / count(*) FROM (SELECT invoice, sum(revenue) AS t FROM sales GROUP BY invoice))
           AS avg_order_value
FROM sales"""

_Q03_BODY = """
SELECT country, CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
       CAST(sum(revenue) AS DOUBLE) AS revenue, count(DISTINCT invoice) AS order_count
FROM sales {where}
GROUP BY 1, 2, 3
ORDER BY revenue DESC, country ASC NULLS FIRST, year ASC NULLS FIRST, month ASC NULLS FIRST"""

Q03 = _with(SALES) + _Q03_BODY.format(where="")

Q04 = _with(SALES) + """
SELECT stock_code, description, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
FROM sales
GROUP BY stock_code, description
ORDER BY sum(revenue) DESC, stock_code ASC NULLS FIRST, description ASC NULLS FIRST
LIMIT 10"""

Q05 = _with(SALES) + """
SELECT year, month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(sum(revenue) OVER (ORDER BY year, month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
           AS cumulative_revenue,
       CAST(sum(revenue) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
           / CAST(count(revenue) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
           AS moving_avg_3mo
FROM (
    SELECT CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
           sum(revenue) AS revenue
    FROM sales GROUP BY 1, 2
)
ORDER BY year, month"""

Q06 = _with(SALES) + """
SELECT country, customer_id, CAST(total AS DOUBLE) AS total_spend, rank_in_country
FROM (
    SELECT country, customer_id, total,
           CAST(row_number() OVER (PARTITION BY country ORDER BY total DESC, customer_id ASC) AS INTEGER)
               AS rank_in_country
    FROM (SELECT country, customer_id, sum(revenue) AS total FROM sales GROUP BY country, customer_id)
)
WHERE rank_in_country <= 5
ORDER BY country, rank_in_country"""

Q07 = _with(SALES, """
totals AS (SELECT customer_id, sum(revenue) AS total FROM sales GROUP BY customer_id),
baseline AS (SELECT CAST(sum(total) AS DOUBLE) / count(total) AS b FROM totals)""") + """
SELECT customer_id, CAST(total AS DOUBLE) AS total_spend, (SELECT b FROM baseline) AS avg_spend_baseline
FROM totals
WHERE CAST(total AS DOUBLE) > (SELECT b FROM baseline)
ORDER BY total_spend DESC, customer_id"""

_Q08_BODY = """
SELECT {region} AS region, CAST(sum(s.revenue) AS DOUBLE) AS revenue,
       count(DISTINCT s.customer_id) AS distinct_customers
FROM sales s LEFT JOIN country_region cr ON s.country = cr.country
GROUP BY 1
ORDER BY revenue DESC, region ASC NULLS FIRST"""

Q08 = _with(SALES, LOOKUP) + _Q08_BODY.format(region="cr.region")
Q08_DEFAULT = _with(SALES, PART_LOOKUP) + _Q08_BODY.format(region="coalesce(cr.region, 'Unknown')")

Q09 = _with(SALES, """
monthly AS (
    SELECT customer_id, CAST(year(invoice_date) * 12 + month(invoice_date) AS INTEGER) AS month_index,
           sum(revenue) AS spend
    FROM sales GROUP BY 1, 2
)""") + """
SELECT cur.customer_id, cur.month_index, CAST(cur.spend AS DOUBLE) AS month_spend,
       CAST(prev.spend AS DOUBLE) AS prev_month_spend, CAST(cur.spend - prev.spend AS DOUBLE) AS delta
FROM monthly cur JOIN monthly prev
  ON cur.customer_id = prev.customer_id AND cur.month_index = prev.month_index + 1
ORDER BY delta DESC, cur.customer_id, cur.month_index"""

Q10 = _with(SALES, RFM) + """
SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score, segment FROM segments"""

Q10_SUMMARY = _with(SALES, RFM) + """
SELECT segment, count(*) AS customer_count,
       CAST(round(sum(monetary_exact), 2) AS DOUBLE) AS segment_revenue
FROM segments GROUP BY segment
ORDER BY segment_revenue DESC, segment"""

Q10_SIZES = _with(SALES, RFM) + """
SELECT segment, count(*) AS "count" FROM segments GROUP BY segment ORDER BY "count" DESC, segment"""

Q10_TOP = _with(SALES, RFM) + """
SELECT segment, customer_id, recency_days, frequency, monetary
FROM (
    SELECT *, row_number() OVER (PARTITION BY segment ORDER BY monetary_exact DESC, customer_id ASC) AS rn
    FROM segments
)
WHERE rn <= 5
ORDER BY segment, monetary DESC, customer_id"""

CUSTOMER_TOTALS = _with(SALES) + """
SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS total_spend FROM sales GROUP BY customer_id"""

INVOICE_TOTALS_MEAN = _with(SALES) + """
SELECT count(*) AS invoices, CAST(sum(t) AS DOUBLE) / count(*) AS avg_order_value
FROM (SELECT invoice, sum(revenue) AS t FROM sales GROUP BY invoice)"""

GLOBAL_NTILE = _with(SALES) + """
SELECT customer_id, CAST(total AS DOUBLE) AS total_spend,
       CAST(ntile(10) OVER (ORDER BY total DESC NULLS LAST, customer_id ASC) AS INTEGER) AS decile
FROM (SELECT customer_id, sum(revenue) AS total FROM sales GROUP BY customer_id)"""

PRUNED = _with(SALES) + _Q03_BODY.format(where="WHERE year(invoice_date) IN (1996, 1997)")


LEAP = _with(SALES) + _Q03_BODY.format(where="WHERE year(invoice_date) % 4 = 0 AND (year(invoice_date) % 100 <> 0 OR year(invoice_date) % 400 = 0)")

RUNNING = _with(SALES) + """
SELECT invoice, invoice_date, CAST(total AS DOUBLE) AS total,
       CAST(sum(total) OVER (ORDER BY invoice_date, invoice ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_total,
       CAST(sum(total) OVER (ORDER BY invoice_date, invoice ROWS 2 PRECEDING) AS DOUBLE)
           / count(*) OVER (ORDER BY invoice_date, invoice ROWS 2 PRECEDING) AS moving_avg_3
FROM (SELECT invoice, min(invoice_date) AS invoice_date, sum(revenue) AS total FROM sales GROUP BY invoice)"""

CUSTOMER_LISTS = _with(SALES, """
totals AS (SELECT customer_id, sum(revenue) AS total FROM sales GROUP BY customer_id),
baseline AS (SELECT CAST(sum(total) AS DOUBLE) / count(total) AS b FROM totals)""") + """
(SELECT 'top' AS list, customer_id, CAST(total AS DOUBLE) AS total_spend FROM totals ORDER BY total DESC, customer_id LIMIT 10)
UNION ALL
SELECT 'above_mean', customer_id, CAST(total AS DOUBLE) FROM totals WHERE CAST(total AS DOUBLE) > (SELECT b FROM baseline)"""

BRANDS = _with(SALES) + """
SELECT coalesce(p_brand, 'Unknown') AS brand, CAST(sum(revenue) AS DOUBLE) AS revenue, count(*) AS lines
FROM sales LEFT JOIN part ON stock_code = CAST(p_partkey AS VARCHAR)
GROUP BY 1"""

LINES = _with(RAW_SALES) + """
SELECT CASE WHEN invoice NOT LIKE 'C%' THEN 'none'
            ELSE ['quantity', 'invoice_date', 'price', 'fields'][length(stock_code) % 4 + 1] END AS reason,
       count(*) AS lines, CAST(sum(quantity * price) FILTER (invoice NOT LIKE 'C%') AS DOUBLE) AS revenue
FROM raw_sales GROUP BY 1"""


def queries() -> dict[str, str]:
    out = {
        "q01_clean_filter": Q01,
        "q02_summary": Q02,
        "q03_revenue_by_country_month": Q03,
        "q04_top_products": Q04,
        "q05_monthly_trend": Q05,
        "q06_top_customers_per_country": Q06,
        "q07_above_mean_customers": Q07,
        "q08_region_lookup_join": Q08,
        "q08_region_default_label": Q08_DEFAULT,
        "q09_month_over_month": Q09,
        "q10_rfm_segments": Q10,
        "q10_rfm_segments_distributed": Q10,
        "q10_segment_summary": Q10_SUMMARY,
        "q10_segment_sizes": Q10_SIZES,
        "q10_top_per_segment": Q10_TOP,
        "customer_totals": CUSTOMER_TOTALS,
        "invoice_totals_mean": INVOICE_TOTALS_MEAN,
        "global_ntile": GLOBAL_NTILE,
        "csv_source_roundtrip": Q03,
        "partitioned_write_pruned_read": PRUNED,
        "q09_clustered_copy": Q09,
        "calendar_pruned_sales": LEAP,
        "running_invoice_totals": RUNNING,
        "kept_summary": Q02,
        "kept_revenue_by_month": Q03,
        "kept_revenue_by_region": Q08,
        "kept_customer_lists": CUSTOMER_LISTS,
        "revenue_by_brand": BRANDS,
        "text_lines_split": LINES,
    }
    # The Spark SQL surface answers the same questions as the DataFrame forms.
    for n, key in enumerate(
        [
            "q01_clean_filter",
            "q02_summary",
            "q03_revenue_by_country_month",
            "q04_top_products",
            "q05_monthly_trend",
            "q06_top_customers_per_country",
            "q07_above_mean_customers",
            "q08_region_lookup_join",
            "q09_month_over_month",
            "q10_rfm_segments",
        ],
        start=1,
    ):
        out[f"sql_q{n:02d}"] = out[key]
    return out
