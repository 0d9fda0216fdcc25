import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.operators import topk
from lakeops.operators.topk import sample_exact
from lakeops.plans import datagen

AS_OF = "2024-06-01 00:00:00"


def test_star_counts_keys_and_fk(spark):
    z = {"customers": 300, "products": 50, "orders": 2000, "order_items": 6000}
    t = datagen.star(spark, z, seed=7, as_of=AS_OF)
    c, p, o, i, s = (t[k] for k in ["dim_customers", "dim_products", "dim_orders",
                                     "fact_order_items", "fact_shipments"])
    assert (c.count(), p.count(), o.count(), i.count(), s.count()) == (300, 50, 2000, 6000, 2000)
    assert c.select("email").distinct().count() == 300
    assert o.join(c, "customer_id", "left_anti").count() == 0
    assert i.join(o, "order_id", "left_anti").count() == 0
    assert i.join(p, "product_id", "left_anti").count() == 0
    assert s.join(i, "order_item_id", "left_anti").count() == 0
    r = i.agg(F.min("quantity"), F.max("quantity"), F.min("unit_price_paid"),
              F.max("unit_price_paid")).collect()[0]
    assert 1 <= r[0] and r[1] <= 10 and r[2] >= 5 and r[3] <= 1500
    row = c.where("customer_id = 1").collect()[0]
    first, last = row.customer_name.split(" ")
    assert row.email.startswith(f"{first.lower()}.{last.lower()}")
    ship = s.agg(F.avg(F.col("on_time_delivery").cast("int"))).collect()[0][0]
    assert 0.85 < ship < 0.95


def test_partitioning_does_not_change_rows(spark):
    a = datagen.order_items(spark, 1000, 100, 10, seed=3, as_of=AS_OF, num_partitions=1)
    b = datagen.order_items(spark, 1000, 100, 10, seed=3, as_of=AS_OF, num_partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_emails_stay_unique_beyond_the_fixed_numbers(spark):
    n = datagen.EMAIL_CAPACITY + 500
    df = datagen.customers(spark, n, seed=3, as_of=AS_OF)
    assert df.select("email").distinct().count() == n


def rank(k, seed):
    return int(hashlib.sha256(f"{len(str(k))}:{k}|{seed}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("n", [0, 1, 333, 999, 1000, 5000])
def test_sample_exact_matches_brute_force(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in sample_exact(df, n, ["k"], seed=5).collect())
    want = sorted(sorted(range(1000), key=lambda k: rank(k, 5))[:n])
    assert got == want


def test_generated_star_feeds_reports_and_audit(spark, tmp):
    from lakeops.operators import quality
    from lakeops.plans import reports
    from lakeops.sources.tables import read_star
    z = {"customers": 200, "products": 30, "orders": 1000, "order_items": 3000}
    counts = datagen.write_star(spark, tmp + "/star", z, seed=1, as_of=AS_OF)
    assert counts["fact_shipments"] == 1000
    t = read_star(spark, tmp + "/star")
    rc = {r.table_name: r.row_count for r in reports.row_counts(
        {"dim_customers": t["dim_customers"], "fact_order_items": t["fact_order_items"]}).collect()}
    assert rc == {"dim_customers": 200, "fact_order_items": 3000}
    assert reports.top_products(t["dim_products"], t["fact_order_items"], 10).count() == 10
    by_country = reports.orders_by_country(t["dim_orders"], t["dim_customers"]).collect()
    assert sum(r.total_orders for r in by_country) == 1000
    s = reports.shipment_stats(t["fact_shipments"]).collect()[0]
    assert 5 <= float(s.min_cost) <= float(s.avg_cost) <= float(s.max_cost) <= 50
    bad = [r for r in quality.audit(t).collect() if r.violations]
    assert bad == []


@pytest.mark.parametrize("n", [0, 1, 700, 1500, 2999, 3000, 4000])
@pytest.mark.parametrize("edge_rows", [1 << 16, 1])
def test_sample_of_repeated_keys_is_exact(spark, monkeypatch, n, edge_rows):
    """A third of the rows share one key: the sample still has n rows, all
    keys of smaller rank whole, however large a bucket may be sorted."""
    monkeypatch.setattr(topk, "_EDGE_ROWS", edge_rows)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    got = Counter(r.k for r in sample_exact(df, n, ["k"], seed=1).collect())
    every = Counter(r.k for r in df.collect())
    assert sum(got.values()) == min(n, 3000)
    left = min(n, 3000)
    for k in sorted(every, key=lambda k: (rank(k, 1), k)):
        assert got[k] == min(left, every[k])
        left -= got[k]
