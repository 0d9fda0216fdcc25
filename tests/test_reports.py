import datetime as dt
from decimal import Decimal

import pytest

from lakeops import schemas
from lakeops.plans import reports
from tests.conftest import rows

D = Decimal


@pytest.fixture()
def star(spark):
    products = spark.createDataFrame([
        (1, "Widget", "A", D("5.00"), None),
        (2, "Widget", "B", D("6.00"), None),       # same name as 1: merges
        (3, "Gadget", "A", D("7.00"), None),
        (4, "Unsold", "A", D("8.00"), None),       # never sold
        (5, "Tied", "A", D("1.00"), None),
    ], schemas.DIM_PRODUCTS)
    items = spark.createDataFrame([
        (1, 10, 1, 3, D("5.00"), D("15.00"), None),
        (2, 10, 2, 4, D("6.00"), D("24.00"), None),
        (3, 11, 3, 7, D("7.00"), D("49.00"), None),
        (4, 11, 5, 7, D("1.00"), D("7.00"), None),
        (5, 12, 99, 50, D("1.00"), D("50.00"), None),  # orphan product id
    ], schemas.FACT_ORDER_ITEMS)
    customers = spark.createDataFrame([
        (1, "Anna Smith", "a@x", None, "USA", None),
        (2, "John Brown", "b@x", None, None, None),     # NULL country
        (3, "No Orders", "c@x", None, "FRA", None),
    ], schemas.DIM_CUSTOMERS)
    orders = spark.createDataFrame([
        (10, 1, "PayPal", dt.date(2024, 1, 1), D("0")),
        (11, 1, "PayPal", dt.date(2024, 1, 2), D("0")),
        (12, 2, "Cash", dt.date(2024, 1, 3), D("0")),
    ], schemas.DIM_ORDERS)
    return products, items, customers, orders


def test_row_counts(spark, star):
    p, i, c, o = star
    r = reports.row_counts({"dim_customers": c, "fact_order_items": i})
    assert rows(r) == [("dim_customers", 3), ("fact_order_items", 5)]


def test_avg_sales_and_empty(spark, star):
    _, i, _, _ = star
    assert reports.avg_sales(i).collect()[0][0] == D("29.000000")
    assert reports.avg_sales(i.limit(0)).collect()[0][0] is None


def test_top_products_merge_by_name_and_ties(spark, star):
    p, i, _, _ = star
    r = reports.top_products(p, i, 10).collect()
    assert [(x.product_name, x.total_quantity_sold) for x in r] == [
        ("Gadget", 7), ("Tied", 7), ("Widget", 7)]
    assert reports.top_products(p, i, 1).collect()[0].product_name == "Gadget"
    assert reports.top_products(p, i, 0).count() == 0
    assert reports.top_products(p, i, 100).count() == 3
    with pytest.raises(ValueError):
        reports.top_products(p, i, -1)


def test_shipment_stats(spark):
    s = spark.createDataFrame([
        (1, 1, D("5.00"), None, None, True, False, None),
        (2, 2, D("15.00"), None, None, False, False, None),
        (3, 3, None, None, None, None, False, None),   # NULL flag counts in denominator
        (4, 4, D("10.00"), None, None, True, False, None),
    ], schemas.FACT_SHIPMENTS)
    r = reports.shipment_stats(s).collect()[0]
    assert (r.min_cost, r.max_cost) == (D("5.00"), D("15.00"))
    assert r.avg_cost == D("10.000000")
    assert float(r.on_time_rate_percent) == pytest.approx(50.0)
    e = reports.shipment_stats(s.limit(0)).collect()[0]
    assert e.min_cost is None and e.avg_cost is None and e.on_time_rate_percent is None


def test_orders_by_country(spark, star):
    _, _, c, o = star
    r = reports.orders_by_country(o, c).collect()
    assert [(x.country, x.total_orders) for x in r] == [("USA", 2), (None, 1)]
