"""Every registered query against its DuckDB formulation (sf0.01), and the
SQL surface against the DataFrame forms (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01
from tests.oracle_harness import compare, duck

# the training-data operators have tests of their own
QUERIES = {k: f for k, f in E.queries().items() if not k.startswith("op") and k != "pipeline"}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    res = compare(spark, SF01, name, QUERIES[name], ORACLE.get(name), con)
    assert res["ok"], res


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


DF_FORMS = {
    "sql_q01": "q01_clean_filter",
    "sql_q02": "q02_summary",
    "sql_q03": "q03_revenue_by_country_month",
    "sql_q04": "q04_top_products",
    "sql_q05": "q05_monthly_trend",
    "sql_q06": "q06_top_customers_per_country",
    "sql_q07": "q07_above_mean_customers",
    "sql_q08": "q08_region_lookup_join",
    "sql_q09": "q09_month_over_month",
    "sql_q10": "q10_rfm_segments",
}


@pytest.mark.parametrize("sql_name", sorted(DF_FORMS))
def test_sql_surface_equals_dataframe_form(spark, sql_name):
    a = QUERIES[sql_name](spark, SF001)
    b = QUERIES[DF_FORMS[sql_name]](spark, SF001)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
                          "segment"]


def test_sql_surface_over_another_source(spark):
    from tillroll.plans import sql_surface
    from tillroll.sources import files
    from tillroll.sources.star import sales_from_star

    path = files.fresh_path(spark, "test-sql-csv")
    files.write_sales_csv(sales_from_star(spark, SF001), path)
    expect = [tuple(r) for r in QUERIES["sql_q03"](spark, SF001).collect()]
    sql_surface.register_views(spark, SF001, raw=files.read_sales(spark, path, fmt="csv"))
    got = [tuple(r) for r in spark.sql(sql_surface.SQL_Q03).collect()]
    assert sorted(got) == sorted(expect)


def test_sql_cleaning_reaches_the_scan(spark):
    from tests.fixtures import plan_text

    text = plan_text(QUERIES["sql_q01"](spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text


@pytest.mark.parametrize("name", ["q03_revenue_by_country_month", "csv_source_roundtrip", "q10_rfm_segments"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, SF01, name, QUERIES[name], ORACLE[name], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["ok"], res
