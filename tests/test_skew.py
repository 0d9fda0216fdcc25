"""One key holding a third (or more) of all rows: results must stay whole
and exact through the partial-aggregate paths."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lakeops.operators import quality
from lakeops.operators.dedup import first_per_key
from lakeops.plans import reports, tickets


def test_hot_product_and_customer(spark):
    rnd = random.Random(11)
    items = [(i, 1 if i % 3 == 0 else rnd.randint(2, 40), rnd.randint(1, 10)) for i in range(6000)]
    idf = spark.createDataFrame(items, "order_id int, product_id int, quantity int")
    pdf = spark.createDataFrame([(p, f"name{p % 7}") for p in range(1, 41)],
                                "product_id int, product_name string")
    want = Counter()
    for _, p, q in items:
        want[f"name{p % 7}"] += q
    got = {r.product_name: r.total_quantity_sold
           for r in reports.top_products(pdf, idf.repartition(5), 100).collect()}
    assert got == dict(want)

    orders = spark.createDataFrame([(i, 7 if i % 2 else rnd.randint(1, 50)) for i in range(5000)],
                                   "order_id int, customer_id int")
    cust = spark.createDataFrame([(c, f"C{c % 4}") for c in range(1, 51)],
                                 "customer_id int, country string")
    want = Counter(f"C{c % 4}" for _, c in orders.collect())
    got = {r.country: r.total_orders for r in reports.orders_by_country(orders, cust).collect()}
    assert got == dict(want)


def test_hot_ticket_replay_and_first_wins(spark):
    rnd = random.Random(5)
    log = []
    for lsn in range(9000):
        tid = "hot" if lsn % 3 == 0 else f"t{rnd.randint(0, 300)}"
        op = rnd.choice(["CREATE", "CREATE", "DELETE", "NOOP"])
        log.append((lsn, op, tid, f"n{lsn}", None, None))
    df = spark.createDataFrame(log, "lsn long, op string, ticket_id string, passenger_name string, "
                                    "created_at timestamp, expires_at timestamp").repartition(6)
    state = {}
    for lsn, op, tid, name, _, _ in log:
        if op == "CREATE":
            state[tid] = name
        elif op == "DELETE":
            state.pop(tid, None)
    got = {r.ticket_id: r.passenger_name for r in tickets.replay(df).collect()}
    assert got == state
    firsts = {r.ticket_id: r.lsn for r in first_per_key(df, ["ticket_id"], ["lsn"]).collect()}
    want = {}
    for lsn, _, tid, *_ in log:
        want.setdefault(tid, lsn)
    assert firsts == want


def test_hot_key_audits(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(1))
                                   .otherwise(F.col("id"))).alias("k"))
    u = quality.unique(df, "t", ["k"]).collect()[0].violations
    assert u == 1000 + (1 if 1 % 3 != 0 else 0)
    parent = spark.range(2, 3000).withColumnRenamed("id", "k")
    fk = quality.foreign_key(df, "t", ["k"], parent, ["k"]).collect()[0].violations
    assert fk == 1001          # every row with k = 1 (1000 hot rows + the row id 1)


def test_hot_ticket_join_is_split_by_aqe(spark):
    """validate's left join with one ticket id holding a third of the
    requests: with broadcasts off and small skew thresholds, AQE marks the
    sort-merge join skewed (the hot partition is split) and results stay exact."""
    import datetime as dt
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
        st = spark.createDataFrame(
            [(f"t{i}", f"N{i}", t0, t0 + dt.timedelta(hours=i % 5)) for i in range(200)],
            "ticket_id string, passenger_name string, created_at timestamp, expires_at timestamp")
        reqs = [(r, "t0" if r % 3 == 0 else f"t{r % 200}", t0 + dt.timedelta(minutes=r % 400))
                for r in range(30000)]
        rq = spark.createDataFrame(reqs, "request_id long, ticket_id string, ts timestamp")
        out = tickets.validate(st, rq)
        got = Counter(r.status for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        want = Counter()
        for _, tid, ts in reqs:
            i = int(tid[1:])
            want["valid" if ts <= t0 + dt.timedelta(hours=i % 5) else "expired"] += 1
        assert got == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
