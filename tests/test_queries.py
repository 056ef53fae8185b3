"""Operator semantics on hand-made rows, and plan shapes on the star tables."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.fixtures import executed_plan_text, line, plan_text, sales
from tillroll.operators import aggregates, compare, enrich, rfm, trend
from tillroll.operators.cleaning import clean
from tillroll.plans import queries as Q
from tillroll.sources.lookup import lookup_from_pairs


def clean_rows(spark, rows):
    return clean(sales(spark, rows))


ROWS = [
    line(invoice="1", customer_id=1, quantity=2, price="10.00", invoice_date="1996-01-05 00:00:00", country="A"),
    line(invoice="1", customer_id=1, quantity=1, price="5.00", invoice_date="1996-01-05 00:00:00", country="A"),
    line(invoice="2", customer_id=2, quantity=3, price="1.00", invoice_date="1996-02-10 00:00:00", country="B"),
    line(invoice="3", customer_id=1, quantity=1, price="7.00", invoice_date="1996-02-11 00:00:00", country="A"),
    line(invoice="4", customer_id=3, quantity=4, price="2.50", invoice_date="1996-04-01 00:00:00", country="Z"),
]


def test_summary_matches_hand_values(spark):
    df = clean_rows(spark, ROWS)
    a = aggregates.summary(df).collect()[0].asDict()
    assert a["total_revenue"] == 45.0
    assert a["distinct_invoices"] == 4 and a["distinct_customers"] == 3
    assert a["max_line_revenue"] == 20.0
    assert a["min_invoice_date"] == dt.datetime(1996, 1, 5)
    assert a["avg_order_value"] == 45.0 / 4


def test_summary_of_nothing(spark):
    r = aggregates.summary(clean_rows(spark, [])).collect()[0]
    assert r["total_revenue"] is None and r["distinct_invoices"] == 0 and r["avg_order_value"] is None


def test_revenue_by_cells_sum_to_total(spark):
    df = Q.cleaned(spark, SF001)
    cells = aggregates.revenue_by(df, ["country", F.year("invoice_date").alias("year")], sort=False)
    total = aggregates.summary(df).collect()[0]["total_revenue"]
    assert abs(sum(r["revenue"] for r in cells.collect()) - total) < 1e-6 * max(1.0, total)


def test_monthly_trend_running_total_and_gap(spark):
    out = trend.monthly_trend(clean_rows(spark, ROWS)).collect()
    # months present: 1996-01, 1996-02, 1996-04 (March is missing: ROWS frame skips over it)
    assert [(r["year"], r["month"]) for r in out] == [(1996, 1), (1996, 2), (1996, 4)]
    assert [r["cumulative_revenue"] for r in out] == [25.0, 35.0, 45.0]
    assert out[0]["moving_avg_3mo"] == 25.0
    assert out[1]["moving_avg_3mo"] == 35.0 / 2
    assert out[2]["moving_avg_3mo"] == 45.0 / 3


def test_month_over_month_needs_consecutive_months(spark):
    rows = [
        line(invoice="1", customer_id=1, price="10.00", invoice_date="1996-01-05 00:00:00"),
        line(invoice="2", customer_id=1, price="4.00", invoice_date="1996-02-05 00:00:00"),
        line(invoice="3", customer_id=1, price="9.00", invoice_date="1996-04-05 00:00:00"),
        line(invoice="4", customer_id=2, price="1.00", invoice_date="1996-12-05 00:00:00"),
        line(invoice="5", customer_id=2, price="3.00", invoice_date="1997-01-05 00:00:00"),
    ]
    out = sorted(tuple(r) for r in trend.month_over_month(clean_rows(spark, rows)).collect())
    assert out == [(1, 1996 * 12 + 2, 4.0, 10.0, -6.0), (2, 1997 * 12 + 1, 3.0, 1.0, 2.0)]


def test_above_mean(spark):
    out = compare.above_mean_customers(clean_rows(spark, ROWS)).collect()
    # totals: c1 = 32, c2 = 3, c3 = 10; mean = 15
    assert [(r["customer_id"], r["total_spend"]) for r in out] == [(1, 32.0)]
    assert out[0]["avg_spend_baseline"] == 15.0


def test_lookup_join_null_and_default(spark):
    lookup = lookup_from_pairs(spark, [("A", "Europe"), ("B", "Asia")])
    df = clean_rows(spark, ROWS)
    got = {r["region"]: (r["revenue"], r["distinct_customers"]) for r in enrich.revenue_by_region(df, lookup).collect()}
    assert got == {"Europe": (32.0, 1), "Asia": (3.0, 1), None: (10.0, 1)}
    got = {r["region"] for r in enrich.revenue_by_region(df, lookup, default="Unknown").collect()}
    assert got == {"Europe", "Asia", "Unknown"}


def test_segments(spark):
    rows = [(r, f, m) for r in (1, 2, 3, 4, 5) for f in (1, 3, 5) for m in (1, 3, 5)]
    df = spark.createDataFrame(rows, "r_score int, f_score int, m_score int").withColumn("segment", rfm.segment_expr())
    seg = {(r["r_score"], r["f_score"], r["m_score"]): r["segment"] for r in df.collect()}
    assert seg[(5, 5, 5)] == "Champions" and seg[(4, 5, 3)] == "Loyal" and seg[(3, 3, 3)] == "Loyal"
    assert seg[(2, 3, 1)] == "At-Risk" and seg[(1, 1, 5)] == "Lost" and seg[(3, 1, 1)] == "Other"
    assert seg[(5, 5, 1)] == "Other"


def test_rfm_on_fixture(spark):
    out = {r["customer_id"]: r for r in rfm.rfm_segments(clean_rows(spark, ROWS)).collect()}
    # last purchase of anyone: 1996-04-01
    assert out[3]["recency_days"] == 0 and out[1]["recency_days"] == 50 and out[2]["recency_days"] == 51
    assert out[1]["frequency"] == 2 and out[1]["monetary"] == 32.0
    assert out[3]["r_score"] == 5 and out[1]["m_score"] == 5


def test_segments_partition_customers(spark):
    seg = Q.q10_rfm_segments(spark, SF001)
    n = seg.count()
    assert n == seg.select("customer_id").distinct().count()
    assert sum(r["count"] for r in rfm.segment_sizes(seg).collect()) == n


def test_money_is_exact_decimal_inside(spark):
    t = aggregates.customer_totals(clean_rows(spark, ROWS))
    assert dict(t.dtypes)["total_spend"].startswith("decimal")
    assert {r["customer_id"]: r["total_spend"] for r in t.collect()}[1] == Decimal("32.00")


# ---- plan shapes on the star tables -------------------------------------


def test_q08_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in executed_plan_text(Q.q08_region_lookup_join(spark, SF001))


def test_q09_self_join_is_sort_merge(spark):
    assert "SortMergeJoin" in plan_text(Q.q09_month_over_month(spark, SF001))


def test_q04_is_top_k_not_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_text(Q.q04_top_products(spark, SF001))


def test_q06_limits_rows_before_shuffle(spark):
    assert "WindowGroupLimit" in plan_text(Q.q06_top_customers_per_country(spark, SF001))


def test_scalars_are_subqueries_not_joins(spark):
    import __spark_entry__ as E

    for name in ("q02_summary", "q07_above_mean_customers", "q10_rfm_segments", "sql_q07", "global_ntile"):
        text = plan_text(E.queries()[name](spark, SF001))
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text, name
        if name in ("q07_above_mean_customers", "sql_q07"):
            assert "Subquery" in text, name


def test_no_python_evaluation_anywhere(spark):
    import __spark_entry__ as E

    for name, fn in E.queries().items():
        if name in ("csv_source_roundtrip", "partitioned_write_pruned_read", "pipeline") or name.startswith("op"):
            continue
        text = plan_text(fn(spark, SF001))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_scans_read_only_needed_columns(spark):
    text = plan_text(Q.q05_monthly_trend(spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert "p_name" not in text.split("ReadSchema: struct<p_partkey")[1].split("\n")[0]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("name", ["q02_summary", "q07_above_mean_customers", "sql_q02", "sql_q07", "q09_month_over_month", "sql_q09"])
def test_sale_lines_are_scanned_once(spark, name, broadcast):
    import __spark_entry__ as E

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, broadcast)
    try:
        assert scans(E.queries()[name](spark, SF001)) == 1
    finally:
        for k, v in zip(keys, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("sql", [False, True])
def test_rfm_metrics_scan_the_sale_lines_once(spark, sql):
    from tillroll.plans import sql_surface

    if sql:
        sql_surface.register_views(spark, SF001)
        df = spark.sql(sql_surface._rfm_base_sql())
    else:
        df = rfm.rfm_metrics(Q.cleaned(spark, SF001))
    assert scans(df) == 1


def scans(df):
    """Scans of lineitem in the final plan, after running it."""
    df.collect()
    n, skip = 0, None
    for x in plan_text(df, "simple").splitlines():
        depth = len(x) - len(x.lstrip(" :+-"))
        if skip is not None and depth < skip:
            skip = None
        if skip is None and "== Initial Plan ==" in x:
            skip = depth
        n += skip is None and "FileScan parquet [l_orderkey" in x
    return n


def test_no_shuffle_on_the_nation_key(spark):
    from tillroll.sources.star import sales_from_star

    text = plan_text(sales_from_star(spark, SF001))
    assert "hashpartitioning(c_nationkey" not in text and "hashpartitioning(n_nationkey" not in text


def test_persisted_totals_feed_two_consumers(spark):
    from tillroll.operators.ranking import top_n
    from tillroll.operators.reuse import persisted

    df = clean_rows(spark, ROWS)
    with persisted(aggregates.customer_totals(df)) as totals:
        assert totals.is_cached
        top = [r["customer_id"] for r in top_n(totals, 2, [F.desc("total_spend"), "customer_id"]).collect()]
        above = [r["customer_id"] for r in compare.above_mean(totals).collect()]
    assert not totals.is_cached
    assert top == [1, 3] and above == [1]


def test_guarded_mean_of_nothing(spark):
    empty = aggregates.customer_totals(clean_rows(spark, []))
    assert compare.above_mean(empty).count() == 0
    assert compare.mean_of(empty, "total_spend").collect()[0][0] is None
    assert compare.mean_of(empty, "total_spend", empty_mean=0.0).collect()[0][0] == 0.0
    full = aggregates.customer_totals(clean_rows(spark, ROWS))
    assert compare.mean_of(full, "total_spend", empty_mean=0.0).collect()[0][0] == 15.0


def test_elapsed_versus_calendar_recency(spark):
    rows = [
        line(invoice="1", customer_id=1, invoice_date="1996-01-01 23:00:00"),
        line(invoice="2", customer_id=2, invoice_date="1996-01-02 01:00:00"),
    ]
    df = clean_rows(spark, rows)
    cal = {r["customer_id"]: r["recency_days"] for r in rfm.rfm_metrics(df).collect()}
    ela = {r["customer_id"]: r["recency_days"] for r in rfm.rfm_metrics(df, recency="elapsed").collect()}
    assert cal == {1: 1, 2: 0} and ela == {1: 0, 2: 0}


def test_ties_in_spend_break_on_customer_id(spark):
    rows = [line(invoice=str(i), customer_id=c, price="5.00", country="A") for i, c in enumerate([9, 4, 6, 2], 1)]
    df = clean_rows(spark, rows)
    out = Q.q06_form(df, n=3).collect()
    assert [(r["customer_id"], r["rank_in_country"]) for r in out] == [(2, 1), (4, 2), (6, 3)]
    top = Q.q04_form(sales(spark, [line(invoice=str(i), stock_code=s, price="5.00") for i, s in enumerate([8, 3, 5], 1)])
                     .transform(clean), n=2).collect()
    assert [r["stock_code"] for r in top] == ["3", "5"]


def test_running_total_ends_at_the_total(spark):
    df = Q.cleaned(spark, SF001)
    trendrows = trend.monthly_trend(df).collect()
    total = aggregates.summary(df).collect()[0]["total_revenue"]
    assert trendrows[-1]["cumulative_revenue"] == total
    assert all(a["cumulative_revenue"] <= b["cumulative_revenue"] for a, b in zip(trendrows, trendrows[1:]))


def test_distributed_rfm_rows_are_only_projected(spark):
    main = plan_text(Q.q10_rfm_segments_distributed(spark, SF001)).split("===== Subqueries")[0]
    assert "Exchange" not in main and "Window" not in main


def test_null_group_keys_are_groups(spark):
    rows = [
        line(invoice="1", stock_code=5, description=None, price="3.00", country=None),
        line(invoice="2", stock_code=5, description=None, price="2.00", country=None),
        line(invoice="3", stock_code=5, description="blue bolt", price="1.00", country="A"),
        line(invoice="4", invoice_date=None),
    ]
    df = clean_rows(spark, rows)
    assert df.count() == 3  # NULL date fails the window
    top = {(r["stock_code"], r["description"]): r["revenue"] for r in Q.q04_form(df).collect()}
    assert top == {("5", None): 5.0, ("5", "blue bolt"): 1.0}
    cells = {(r["country"], r["order_count"]) for r in Q.q03_form(df).collect()}
    assert cells == {(None, 2), ("A", 1)}
    lookup = lookup_from_pairs(spark, [("A", "Europe")])
    regions = {r["region"]: r["revenue"] for r in enrich.revenue_by_region(df, lookup).collect()}
    assert regions == {"Europe": 1.0, None: 5.0}


def test_elapsed_recency_ignores_session_time_zone(spark):
    rows = [
        line(invoice="1", customer_id=1, invoice_date="1996-03-30 12:00:00"),
        line(invoice="2", customer_id=2, invoice_date="1996-04-01 12:00:00"),
    ]
    df = clean_rows(spark, rows)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # DST starts 1996-03-31
    try:
        got = {r["customer_id"]: r["recency_days"] for r in rfm.rfm_metrics(df, recency="elapsed").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: 2, 2: 0}
