from decimal import Decimal

import pytest

from tests.fixtures import line, plan_text, sales
from tillroll.operators.cleaning import STAR_END, STAR_START, clean


def kept(spark, row):
    return clean(sales(spark, [row]), STAR_START, STAR_END).count() == 1


def test_valid_line_kept_with_exact_revenue(spark):
    out = clean(sales(spark, [line(quantity=3, price="2.35")])).collect()
    assert len(out) == 1
    assert out[0]["revenue"] == Decimal("7.05")


@pytest.mark.parametrize(
    "row,expected",
    [
        (line(quantity=0), False),
        (line(quantity=-2), False),
        (line(quantity=1), True),
        (line(price="0.00"), False),
        (line(price="-1.00"), False),
        (line(price="0.01"), True),
        (line(price=None), False),
        (line(customer_id=None), False),
        (line(invoice="C100"), False),
        (line(invoice="c100"), True),
        (line(invoice="10C0"), True),
        (line(invoice=None), False),
        (line(invoice_date=STAR_START), True),
        (line(invoice_date="1994-12-31 23:59:59"), False),
        (line(invoice_date=STAR_END), True),
        (line(invoice_date="2001-01-01 00:00:00"), False),
        (line(quantity=None), False),
    ],
)
def test_each_condition_alone(spark, row, expected):
    assert kept(spark, row) is expected


def test_custom_window_and_prefix(spark):
    df = sales(spark, [line(invoice="X1"), line(invoice="Y1", invoice_date="2011-06-01 00:00:00")])
    out = clean(df, start="2011-01-01 00:00:00", end="2011-12-31 23:59:59", cancel_prefix="X").collect()
    assert [r["invoice"] for r in out] == ["Y1"]


def test_empty_input(spark):
    assert clean(sales(spark, [])).count() == 0


def test_filters_reach_the_star_scans(spark):
    from tests.conftest import SF001
    from tillroll.sources.star import sales_from_star

    lines = sales_from_star(spark, SF001)
    plan = plan_text(clean(lines, STAR_START, STAR_END))
    # the date window is a plain column predicate on orders: pushed into the scan
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan
    # so are the rules on the tables' own columns, and the rows stay the same
    valid = clean(sales_from_star(spark, SF001, valid=True))
    plan = plan_text(valid)
    for pushed in ("GreaterThanOrEqual(l_quantity,1.0)", "EqualTo(o_orderstatus,P)", "GreaterThanOrEqual(c_acctbal,0.0)", "GreaterThan(p_retailprice,0.0)"):
        assert pushed in plan, pushed
    every = clean(lines)
    assert valid.exceptAll(every).count() == 0 and every.exceptAll(valid).count() == 0
