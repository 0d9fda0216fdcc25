"""Bench: headline jobs on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; every query runs once to warm the JVM, then each is
timed $BENCH_RUNS times and the median is kept. Each run executes the whole plan into Spark's no-op sink (nothing is
collected). Prints one JSON line.

Unless BENCH_STAR=0, the five star-schema reports are also timed on a
generated star at the reference's own sizes (10k customers, 500 products,
500k orders, 1.5M order items, 500k shipments), the scale its < 1 s
per-report target refers to. That data is generated once into the session's
checkpoint folder and reported under "reference_scale" (not in "value")."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeops.plans import datagen, reports  # noqa: E402
from lakeops.plans.registry import QUERIES  # noqa: E402
from lakeops.session import env_int, get_spark, shared_path  # noqa: E402
from lakeops.sources.paths import path_exists  # noqa: E402
from lakeops.sources.tables import STAR_TABLES, read_star  # noqa: E402


def star_reports(t):
    return {
        "r1_row_counts": lambda: reports.row_counts(
            {"dim_customers": t["dim_customers"], "fact_order_items": t["fact_order_items"]}),
        "r2_avg_sales": lambda: reports.avg_sales(t["fact_order_items"]),
        "r3_top_products": lambda: reports.top_products(t["dim_products"], t["fact_order_items"], 10),
        "r4_shipment_stats": lambda: reports.shipment_stats(t["fact_shipments"]),
        "r5_orders_by_country": lambda: reports.orders_by_country(t["dim_orders"], t["dim_customers"]),
    }


def reference_scale(spark, runs: int) -> dict:
    loc = shared_path(spark, "bench-star-seed42")
    if not all(path_exists(spark, f"{loc}/{n}/_SUCCESS") for n in STAR_TABLES):
        datagen.write_star(spark, loc, seed=42, as_of="2025-01-01 00:00:00")
    t = read_star(spark, loc)
    out = {}
    for name, q in star_reports(t).items():
        q().collect()                                     # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q().collect()
            samples.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(samples), 4)
    return out

HEADLINE = [
    "row_counts", "avg_sales", "top_products", "shipment_stats", "orders_by_country",  # R1-R5
    "silver_events", "gold_stats", "layer_counts",                                     # M2-M4
    "ticket_replay", "validate", "validate_swept",                                     # L2, L5, L6
    "insert_ignore", "order_decode",                                                   # W1 batch, P18
    "quality_foreign_key", "quality_not_null", "quality_unique",                       # Q1-Q3
    "shipment_sample",                                                                 # O3, G7
    "order_stream", "replica_sync", "medallion_run",                                   # write paths
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = env_int("BENCH_CPUS", 8)
    runs = env_int("BENCH_RUNS", 3)
    spark = get_spark(f"local[{cpus}]", app_name="lakeops-bench",
                      shuffle_partitions=max(cpus, 4),
                      extra_conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    names = [n for n in HEADLINE if n in QUERIES]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in QUERIES]
    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:                       # warm-up pass
        run(name)
    times: dict[str, float] = {}
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    result = {"metric": "sum_of_query_medians", "value": round(sum(times.values()), 4),
              "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    if os.environ.get("BENCH_STAR", "1") != "0" and len(sys.argv) <= 1:
        result["reference_scale"] = reference_scale(spark, runs)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
