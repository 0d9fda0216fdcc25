"""The supplied TPC-H-like test tables, presented in the shapes the jobs
expect. Pure projections and one dimension join: Catalyst prunes unused
columns, so a report that needs two columns still scans only two.

Mapping (star schema  <-  supplied tables):
  dim_customers     customer (+ nation name as country)
  dim_products      part
  dim_orders        orders
  fact_order_items  lineitem
  fact_shipments    lineitem (tax as shipping cost, return flag <> 'R' as on time)
  match events      events   (day as match, user as team, props as player)
  ticket log        events   (signup/purchase = CREATE, error = DELETE)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_READ: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied (read-only) tables. The DataFrame is kept per
    session and path, so its schema is read once; it stays lazy, and every
    query still prunes columns and pushes filters into its own scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _READ.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _READ[key] = df
    return df


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("n_name").alias("country")))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("unit_price"))


def dim_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("total_sales"))


def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("line_item_sales"),
        F.col("l_shipdate").alias("created_at"))


def fact_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_tax").alias("shipping_cost"),
        F.col("l_shipdate").cast("date").alias("pickup_date"),
        (F.col("l_returnflag") != F.lit("R")).alias("on_time_delivery"))


def match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the match-event source table (6 columns, source order)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("date").cast("string").alias("match_id"),
        F.col("user_id").cast("string").alias("team"),
        F.col("props").alias("player"),
        F.col("event_type").alias("event_type"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("event_ts"))


def match_events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as match events of the types that the gold metrics count, with
    NULL types (signups), times (every seventh) and teams (every eleventh)."""
    e = table(spark, sf_dir, "events")
    kind = (F.when(F.col("event_type") == "click", "Goal").when(F.col("event_type") == "view", "SHOT on goal")
            .when(F.col("event_type") == "purchase", "foul").when(F.col("event_type") == "error", "offside"))
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("date").cast("string").alias("match_id"),
        F.when(F.col("user_id") % 11 != 0, F.col("user_id").cast("string")).alias("team"),
        F.col("props").alias("player"), kind.alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("date").cast("timestamp_ntz")).alias("event_ts"))


# Fixed mapping of event types onto ticket-log operations for the driver data.
CREATE_TYPES = ("signup", "purchase")
DELETE_TYPES = ("error",)
REQUEST_TYPES = ("click", "view")


def ticket_log(spark: SparkSession, sf_dir: str, ttl: str = "7 days") -> DataFrame:
    """events as a parsed ticket log: lsn = event_id, ticket = user id.
    Other event types are carried with their own op name and ignored by the
    replay, like unknown ops in a real log."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts")
    op = (F.when(F.col("event_type").isin(*CREATE_TYPES), F.lit("CREATE"))
          .when(F.col("event_type").isin(*DELETE_TYPES), F.lit("DELETE"))
          .otherwise(F.upper("event_type")))
    return e.select(
        F.col("event_id").alias("lsn"), op.alias("op"),
        F.col("user_id").cast("string").alias("ticket_id"),
        F.concat(F.lit("passenger "), F.col("user_id").cast("string")).alias("passenger_name"),
        ts.alias("created_at"),
        (ts + F.expr(f"INTERVAL {ttl}")).alias("expires_at"))


def ticket_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_type").isin(*REQUEST_TYPES))
            .select(F.col("event_id").alias("request_id"),
                    F.col("user_id").cast("string").alias("ticket_id"),
                    F.col("ts").alias("ts")))


def order_messages(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """events as an order topic: offset = event_id (also the message's seq), one order id per user
    and day (so ids repeat), item = event type. The quantity token varies
    with the event type to exercise typed coercion: a JSON number (value)
    for most events, a numeric string for signups, a non-numeric string
    for errors (rejected)."""
    e = table(spark, sf_dir, "events")
    if where is not None:
        e = e.where(where)
    k = F.get_json_object("props", "$.k")
    qty = (F.when(F.col("event_type") == "error", F.concat(F.lit('"'), k, F.lit('x"')))
           .when(F.col("event_type") == "signup", F.concat(F.lit('"'), k, F.lit('"')))
           .otherwise(F.col("value").cast("string")))
    value = F.format_string('{"seq": %s, "order_id": "%s", "user": "%s", "item": "%s", "quantity": %s}',
                            F.col("event_id").cast("string"), order_id_col(),
                            F.concat(F.lit("user"), F.col("user_id").cast("string")),
                            F.col("event_type"), qty)
    return e.select(F.col("event_id").alias("offset"), value.alias("value"))


def order_id_col():
    return F.concat(F.lit("order-"), F.col("user_id").cast("string"), F.lit("-"),
                    F.col("ts").cast("date").cast("string"))


def one_file(spark: SparkSession, folder: str, path: str, step: int, steps: int) -> None:
    """Join the text files of ``folder``, in order of their names, into the one file
    ``path``, up to ``step`` of ``steps`` equal shares of their bytes: a log
    that one writer has appended to so far."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(((s.getPath().getName(), s) for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")),
                   key=lambda x: x[0])
    left = sum(int(s.getLen()) for _, s in parts) * step // steps
    out = fs.create(jvm.org.apache.hadoop.fs.Path(path), True)
    for _, s in parts:
        n = min(left, int(s.getLen()))
        source = fs.open(s.getPath())
        jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, n)
        source.close()
        left -= n
    out.close()
