"""Retail reports and integrity checks on a micro-fixture."""

import datetime as dt
from decimal import Decimal as D

import pytest

from quarry.operators import quality, retail
from tests.micro import retail_micro


@pytest.fixture(scope="module")
def m(spark):
    return retail_micro(spark)


def test_customer_report_keeps_customers_without_orders(m):
    out = {r.customer_id: r for r in retail.customer_report(m).collect()}
    assert out[1].total_orders == 1 and out[1].total_revenue == D("105.00")
    assert out[1].avg_order_value == 52.5 and out[1].first_order == dt.date(2024, 1, 5)
    assert out[3].total_orders == 0 and out[3].total_revenue is None
    assert len(out) == 3
    assert [r.customer_id for r in retail.customer_report(m).collect()][-1] == 3


def test_monthly_summary_distinct_counts(m):
    out = {r.month: r for r in retail.monthly_summary(m).collect()}
    jan, mar = out[dt.date(2024, 1, 1)], out[dt.date(2024, 3, 1)]
    assert (jan.order_count, jan.customer_count, jan.revenue) == (1, 1, D("105.00"))
    assert (mar.order_count, mar.customer_count, mar.revenue) == (2, 2, D("110.00"))
    assert dt.date(2024, 2, 1) not in out  # a month without orders has no row


def test_product_performance(m):
    out = {r.product_id: r for r in retail.product_performance(m).collect()}
    assert (out[10].times_ordered, out[10].total_quantity_sold, out[10].total_revenue) == \
        (2, 6.0, D("15.00"))
    assert (out[11].times_ordered, out[11].total_revenue) == (2, D("200.00"))


def test_orphans(m):
    assert quality.orphan_customers(m).collect()[0][0] == 1
    assert quality.orphan_products(m).collect()[0][0] == 0


def test_order_details_and_totals(m):
    d = retail.order_details(m, n=3).collect()
    assert [r.order_id for r in d] == [100, 100, 101]
    assert d[2].customer_name == "Bolt"
    t = retail.order_totals(m).collect()[0]
    assert (t.total_orders, t.unique_customers, t.unique_products) == (3, 3, 2)
    assert t.total_revenue == D("215.00")


def test_monthly_kpi_change(m):
    out = {(r.month, r.metric): r for r in retail.monthly_kpi(m).collect()}
    rev = out[(dt.date(2024, 3, 1), "Revenue")]
    assert rev.value == 110.0 and rev.change_pct == pytest.approx(4.76)
    assert out[(dt.date(2024, 1, 1), "Revenue")].change_pct is None


def test_orders_by_category(m):
    out = {r.category: r for r in retail.orders_by_category(m).collect()}
    assert out["Software"].order_count == 2 and out["Hardware"].total_quantity == 6.0
