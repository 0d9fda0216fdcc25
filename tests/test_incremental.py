"""Reports kept from new files against the full query after each load."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lakeops.plans import incremental as inc
from lakeops.plans import medallion, reports
from lakeops.sinks import bucketed

from .conftest import rows as listed

ITEMS = "product_id int, quantity int, line_item_sales decimal(12,2)"


def test_each_load_equals_the_full_query(spark, tmp):
    rng = random.Random(1)
    products = spark.createDataFrame([(i, f"p{i % 7}") for i in range(20)], "product_id int, product_name string")
    schema = spark.createDataFrame([], ITEMS).schema
    for kept in ("p", "s"):
        assert inc.update(spark, f"{tmp}/{kept}", inc.PRODUCTS if kept == "p" else inc.SALES, tmp + "/src", schema) == 0
    for n in (30, 1, 0, 50):
        (spark.createDataFrame([(rng.randrange(25), rng.choice([None, 1, 5]), rng.choice([None, 12, 7]))
                                for _ in range(n)], "product_id int, quantity int, s int")
         .select("product_id", "quantity", F.col("s").cast("decimal(12,2)").alias("line_item_sales"))
         .coalesce(1).write.mode("append").parquet(tmp + "/src"))
        assert inc.update(spark, tmp + "/p", inc.PRODUCTS, tmp + "/src", schema) == 1
        assert inc.update(spark, tmp + "/s", inc.SALES, tmp + "/src", schema) == 1
        assert inc.update(spark, tmp + "/s", inc.SALES, tmp + "/src", schema) == 0
        every = spark.read.schema(schema).parquet(tmp + "/src")
        assert (inc.top_products(inc.state(spark, tmp + "/p", inc.PRODUCTS, schema), products, 5).collect()
                == reports.top_products(products, every, 5).collect())
        got = inc.avg_sales(inc.state(spark, tmp + "/s", inc.SALES, schema)).first()[0]
        want = reports.avg_sales(every).first()[0]
        assert got is None and want is None or float(got) == pytest.approx(float(want))


def test_shipments_orders_rows_and_silver(spark, tmp):
    rng = random.Random(2)
    ships = "shipping_cost double, on_time_delivery boolean"
    orders, events = "customer_id int, order_id int", ("event_id string, match_id string, team string, player string, "
                                                       "event_type string, event_ts timestamp_ntz")
    customers = spark.createDataFrame([(i, rng.choice(["A", "B", None])) for i in range(12)], "customer_id int, country string")
    import datetime as dt
    makes = {
        "ship": (ships, inc.SHIPMENTS, lambda: (rng.choice([None, 1.5, 9.0, -2.0]), rng.choice([None, True, False]))),
        "ord": (orders, inc.CUSTOMERS, lambda: (rng.randrange(15), rng.choice([None, 3]))),
        "ev": (events, inc.silver_keys("2024-01-01 00:00:00"), lambda: (
            "e", rng.choice("mn"), rng.choice(["t", "u", None]), rng.choice("pq"), rng.choice(["Goal", "foul", None]),
            rng.choice([None, dt.datetime(2024, 1, 2)]))),
    }
    for name, (ddl, kept, row) in makes.items():
        schema, path = spark.createDataFrame([], ddl).schema, f"{tmp}/{name}"
        for _ in range(3):
            spark.createDataFrame([row() for _ in range(25)], ddl).write.mode("append").parquet(path)
            assert inc.update(spark, path + "-kept", kept, path, schema) > 0
            every, s = spark.read.schema(schema).parquet(path), inc.state(spark, path + "-kept", kept, schema)
            if name == "ship":
                got, want = inc.shipment_stats(s).first(), reports.shipment_stats(every).first()
                assert [float(x) for x in got] == pytest.approx([float(x) for x in want])
            elif name == "ord":
                assert inc.orders_by_country(s, customers).collect() == reports.orders_by_country(every, customers).collect()
            else:
                want = medallion.silver(medallion.bronze(every), "2024-01-01 00:00:00")
                assert listed(s.select(*want.columns)) == listed(want)
                assert listed(inc.gold(s)) == listed(medallion.gold(want))


def test_only_new_files_and_touched_buckets(spark, tmp):
    schema = spark.createDataFrame([], "customer_id int, order_id int").schema
    spark.range(2000).selectExpr("int(id) customer_id", "int(id) order_id").coalesce(2).write.mode("append").parquet(tmp + "/src")
    assert inc.update(spark, tmp + "/k", inc.CUSTOMERS, tmp + "/src", schema) == 2
    _, _, before = bucketed.current(spark, tmp + "/k", inc.BUCKETS)
    first = [f for f in os.listdir(tmp + "/src") if f.endswith(".parquet")]
    spark.range(1).selectExpr("7 customer_id", "1 order_id").coalesce(1).write.mode("append").parquet(tmp + "/src")
    assert inc.update(spark, tmp + "/k", inc.CUSTOMERS, tmp + "/src", schema) == 1
    _, _, after = bucketed.current(spark, tmp + "/k", inc.BUCKETS)
    assert sum(before[b] != after[b] for b in after) == 1
    assert inc.state(spark, tmp + "/k", inc.CUSTOMERS, schema).where("customer_id = 7").first().n == 2
    os.remove(f"{tmp}/src/{first[0]}")
    with pytest.raises(ValueError, match="gone or changed"):
        inc.update(spark, tmp + "/k", inc.CUSTOMERS, tmp + "/src", schema)


def test_an_update_that_died_is_made_again(spark, tmp, monkeypatch):
    schema = spark.createDataFrame([], "x int").schema
    spark.createDataFrame([(1,), (2,)], schema).write.parquet(tmp + "/src")
    with monkeypatch.context() as m:
        m.setattr(bucketed, "write", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            inc.update(spark, tmp + "/k", inc.ROWS, tmp + "/src", schema)
    assert inc.folded(spark, tmp + "/k").count() == 0
    inc.update(spark, tmp + "/k", inc.ROWS, tmp + "/src", schema)
    assert inc.row_count(inc.state(spark, tmp + "/k", inc.ROWS, schema), "t").collect()[0].row_count == 2
