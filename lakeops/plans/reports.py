"""Star-schema reports R1-R5.

Inputs are DataFrames in the star-schema shape (see ``lakeops.schemas``);
each function returns the report as a lazy DataFrame.

Scale notes: R3 and R5 aggregate the fact table on its join key *before*
joining the dimension, so the map-side partial aggregate collapses a hot key
(one product or customer holding a third of the rows) to one row per task
before any shuffle, and the join sees one row per key instead of one per fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag_to_int
from ..operators.topk import top_k


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table (UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def avg_sales(items: DataFrame, column: str = "line_item_sales") -> DataFrame:
    """R2: global average; one row, NULL on empty input."""
    return items.agg(F.avg(column).alias("average_line_item_sales"))


def top_products(products: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Top-n product *names* by quantity sold.

    Products sharing a name merge (grouping is by name); products never sold
    do not appear (inner join). Ties are broken by name so results are stable.
    The product side is broadcast only when Catalyst's size check (file
    statistics, re-checked by AQE on the runtime size) allows it; otherwise
    the per-product sums and the products meet in a sort-merge join.
    """
    per_product = (items.groupBy("product_id")
                   .agg(F.sum("quantity").alias("qty")))
    names = products.select("product_id", "product_name")
    by_name = (per_product.join(names, "product_id")
               .groupBy("product_name")
               .agg(F.sum("qty").alias("total_quantity_sold")))
    return top_k(by_name, n, [F.desc("total_quantity_sold"), F.asc("product_name")])


def on_time_rate(flag: str = "on_time_delivery"):
    """CAST(SUM(CASE WHEN flag THEN 1 ELSE 0 END) AS NUMERIC) * 100 / COUNT(*).
    NULL flags count in the denominator; empty input gives NULL."""
    hits = F.sum(flag_to_int(flag)).cast("decimal(20,0)")
    return (hits * F.lit(100)) / F.count(F.lit(1))


def shipment_stats(shipments: DataFrame) -> DataFrame:
    """min/max/avg shipping cost and the on-time percentage, one pass."""
    return shipments.agg(
        F.min("shipping_cost").alias("min_cost"),
        F.max("shipping_cost").alias("max_cost"),
        F.avg("shipping_cost").alias("avg_cost"),
        on_time_rate().alias("on_time_rate_percent"))


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """COUNT(order_id) per customer country, largest first.

    Orders are counted per customer first (partial aggregate, skew-proof),
    then joined to customers and summed per country. A NULL country is its
    own group; customers without orders do not appear.
    """
    per_customer = (orders.groupBy("customer_id")
                    .agg(F.count("order_id").alias("n")))
    by_country = (per_customer.join(customers.select("customer_id", "country"),
                                    "customer_id")
                  .groupBy("country")
                  .agg(F.sum("n").cast("bigint").alias("total_orders")))
    return by_country.orderBy(F.desc("total_orders"), F.asc_nulls_first("country"))
