from decimal import Decimal

from lakeops import schemas
from lakeops.operators import quality


def test_audit_star(spark):
    c = spark.createDataFrame([
        (1, "Anna Smith", "dup@x", None, "USA", None),
        (2, "John Brown", "dup@x", None, "GBR", None),        # duplicate email
        (3, "A" * 51, None, None, "FRA", None),               # 51 chars; null email ok
        (4, "Maria Davis", None, None, None, None),           # second null email ok
    ], schemas.DIM_CUSTOMERS)
    o = spark.createDataFrame([(1, 1, "PayPal", None, None), (2, 9, None, None, None)],
                              "order_id int, customer_id int, payment_method string, "
                              "order_date date, total_sales decimal(12,2)")
    got = {(r.table_name, r.rule, r.column_name): r.violations
           for r in quality.audit({"dim_customers": c, "dim_orders": o}).collect()}
    assert got[("dim_customers", "unique", "email")] == 2
    assert got[("dim_customers", "unique", "customer_id")] == 0
    assert got[("dim_customers", "max_length", "customer_name")] == 1
    assert got[("dim_orders", "foreign_key", "customer_id")] == 1
    assert got[("dim_orders", "not_null", "order_date")] == 2
    assert got[("dim_customers", "not_null", "customer_name")] == 0
