"""R1-R5 star-schema reports over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import testdata as td
from .. import reports
from .base import register


# --------------------------------------------------------------------------
# R1-R5 star-schema reports
# --------------------------------------------------------------------------
@register("row_counts", """
SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL
SELECT 'lineitem' AS table_name, COUNT(*) AS row_count FROM lineitem
""")
def q_row_counts(spark, d):
    return reports.row_counts({"customer": td.table(spark, d, "customer"),
                               "lineitem": td.table(spark, d, "lineitem")})


@register("avg_sales", """
SELECT ROUND(AVG(l_extendedprice), 4) AS average_line_item_sales FROM lineitem
""")
def q_avg_sales(spark, d):
    r = reports.avg_sales(td.fact_order_items(spark, d))
    return r.select(F.round("average_line_item_sales", 4).alias("average_line_item_sales"))


@register("top_products", """
SELECT p.p_name AS product_name, SUM(l.l_quantity) AS total_quantity_sold
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey
GROUP BY p.p_name
ORDER BY total_quantity_sold DESC, product_name
LIMIT 10
""")
def q_top_products(spark, d, n=10):
    return reports.top_products(td.dim_products(spark, d), td.fact_order_items(spark, d), n)


@register("shipment_stats", """
SELECT MIN(l_tax) AS min_cost, MAX(l_tax) AS max_cost,
       ROUND(AVG(l_tax), 6) AS avg_cost,
       ROUND(CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS DOUBLE) * 100
             / COUNT(*), 6) AS on_time_rate_percent
FROM lineitem
""")
def q_shipment_stats(spark, d):
    r = reports.shipment_stats(td.fact_shipments(spark, d))
    return r.select("min_cost", "max_cost", F.round("avg_cost", 6).alias("avg_cost"),
                    F.round(F.col("on_time_rate_percent").cast("double"), 6)
                    .alias("on_time_rate_percent"))


@register("orders_by_country", """
SELECT n.n_name AS country, COUNT(o.o_orderkey) AS total_orders
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
ORDER BY total_orders DESC, country NULLS FIRST
""")
def q_orders_by_country(spark, d):
    return reports.orders_by_country(td.dim_orders(spark, d), td.dim_customers(spark, d))
