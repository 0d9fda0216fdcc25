"""Reports kept up to date: the source arrives in LOADS portions of its rows,
each is folded from its new files alone, and the report is read from the stored
aggregates after the last."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import testdata as td
from .. import incremental as inc
from .base import ORACLE_SQL, register, run_dir
from .match_events import AS_OF

LOADS = 3


def _kept(spark, name, kept, source):
    run = run_dir(spark, name)
    dealt = source.withColumn("_load", F.pmod(F.xxhash64(*source.columns), F.lit(LOADS)))
    for load in range(LOADS):
        dealt.where(F.col("_load") == load).drop("_load").write.mode("append").parquet(f"{run}/source")
        inc.update(spark, f"{run}/kept", kept, f"{run}/source", source.schema)
    return inc.state(spark, f"{run}/kept", kept, source.schema)


@register("row_counts_kept", ORACLE_SQL["row_counts"])
def q_row_counts_kept(spark, d):
    parts = [inc.row_count(_kept(spark, f"rows_{t}", inc.ROWS, td.table(spark, d, t)), t) for t in ("customer", "lineitem")]
    return parts[0].unionByName(parts[1])


@register("avg_sales_kept", ORACLE_SQL["avg_sales"])
def q_avg_sales_kept(spark, d):
    r = inc.avg_sales(_kept(spark, "avg_sales", inc.SALES, td.fact_order_items(spark, d)))
    return r.select(F.round("average_line_item_sales", 4).alias("average_line_item_sales"))


@register("top_products_kept", ORACLE_SQL["top_products"])
def q_top_products_kept(spark, d):
    return inc.top_products(_kept(spark, "top_products", inc.PRODUCTS, td.fact_order_items(spark, d)),
                            td.dim_products(spark, d))


@register("shipment_stats_kept", ORACLE_SQL["shipment_stats"])
def q_shipment_stats_kept(spark, d):
    r = inc.shipment_stats(_kept(spark, "shipments", inc.SHIPMENTS, td.fact_shipments(spark, d)))
    return r.select("min_cost", "max_cost", F.round("avg_cost", 6).alias("avg_cost"),
                    F.round(F.col("on_time_rate_percent").cast("double"), 6).alias("on_time_rate_percent"))


@register("orders_by_country_kept", ORACLE_SQL["orders_by_country"])
def q_orders_by_country_kept(spark, d):
    return inc.orders_by_country(_kept(spark, "orders_by_country", inc.CUSTOMERS, td.dim_orders(spark, d)),
                                 td.dim_customers(spark, d))


@register("gold_stats_kept", ORACLE_SQL["gold_stats"])
def q_gold_stats_kept(spark, d):
    return inc.gold(_kept(spark, "gold", inc.silver_keys(AS_OF), td.match_events(spark, d)))
