import itertools
import random

from pyspark.sql import functions as F

from lakeops.operators.scan import exclusive_running_max, last_before


def test_exclusive_running_max_vs_loop(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([5, 5, 5, rnd.randint(0, 50)]), i,
             None if rnd.random() < 0.4 else rnd.randint(-100, 10**15)) for i in range(2000)]
    df = spark.createDataFrame(data, "t long, id long, v long")
    want, best = {}, None
    for t, i, v in sorted(data):
        want[i] = best
        if v is not None:
            best = v if best is None else max(best, v)
    for n in (1, 3, 16):
        got = {r.id: r.p for r in exclusive_running_max(df, ["t", "id"], "v", "p", n)
               .select("id", "p").collect()}
        assert got == want
    assert exclusive_running_max(df.limit(0), ["t", "id"], "v", "p").count() == 0


def test_exact_beyond_two_to_the_53(spark):
    big = 2 ** 62
    df = spark.createDataFrame([(1, big + 1), (2, None), (3, big + 3), (4, 5)], "t long, v long")
    got = {r.t: r.p for r in exclusive_running_max(df, ["t"], "v", "p", 2).collect()}
    assert got == {1: None, 2: big + 1, 3: big + 1, 4: big + 3}


def test_no_plan_choice_changes_the_scan(spark):
    """Equal to a window over everything, with a hot instant, whether or not
    exchanges are reused and plans adapted."""
    df = spark.range(0, 300_000, 1, 6).select(
        "id", (F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)))).alias("t"),
        F.when(F.col("id") % 5 > 1, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10 ** 9))).alias("v"))
    over = F.expr("max(v) OVER (ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    check = [F.count(F.lit(1)), F.sum(F.xxhash64("id", "p").cast("decimal(38,0)"))]
    want = df.withColumn("p", over).agg(*check).first()
    keys = ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(k) for k in keys]
    try:
        for values in itertools.product(("true", "false"), repeat=2):
            for k, v in zip(keys, values):
                spark.conf.set(k, v)
            assert exclusive_running_max(df, ["t", "id"], "v", "p", 7).agg(*check).first() == want
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)


def test_last_before_vs_loop(spark):
    rnd = random.Random(9)
    data = [(rnd.choice(["hot", "hot", f"k{rnd.randint(0, 20)}", None]), rnd.randint(0, 30), i,
             None if rnd.random() < 0.7 else f"r{i}") for i in range(1500)]
    df = spark.createDataFrame(data, "k string, t long, id long, r string")
    want, last = {}, {}
    for k, t, i, r in sorted(data, key=lambda x: (x[1], x[2])):
        want[i] = last.get(k)
        if r is not None:
            last[k] = r
    for n in (1, 4, 13):
        got = {r.id: r.p for r in last_before(df, "k", ["t", "id"], F.col("r"), "p", n).select("id", "p").collect()}
        assert got == want
    out = last_before(df, "k", ["t", "id"], F.col("r"), "p", 13)
    assert out.columns == [*df.columns, "p"]
    assert last_before(df.limit(0), "k", ["t", "id"], F.col("r"), "p").count() == 0


def test_segments_follow_the_input_not_a_join_estimate(spark):
    from lakeops.operators.scan import segments_for
    a, b = spark.range(200_000), spark.range(200_000).withColumnRenamed("id", "k")
    joined = a.join(b, a.id == b.k, "left")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert segments_for(joined) == least
    assert segments_for(joined, 100_000) == 32
