"""Seeded star-schema generator (G1-G7), distributed.

Rows come from ``spark.range``; every random draw is a seeded 64-bit hash of
(row id, seed, column tag), so the output is the same for any partitioning
and on task retry (``rand()`` depends on the partitioning). Foreign keys
pick a parent by hash modulo the parent count (parents are numbered 1..n),
so no id list is collected on the driver. Emails are unique by construction:
the row number is permuted and written in mixed radix over
(first name, last name, number, domain), so no retry loop is needed; more
customers than distinct emails is an error.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.topk import sample_exact

# The value domains of the generated data.
CITIES = ["New York", "London", "Paris", "Tokyo", "Berlin", "Sydney", "Dubai", "Singapore"]
COUNTRIES = ["USA", "GBR", "FRA", "JPN", "DEU", "AUS", "ARE", "SGP"]
PRODUCT_CATEGORIES = ["Electronics", "Apparel", "Home Goods", "Books", "Software", "Food"]
PAYMENT_METHODS = ["Credit Card", "PayPal", "Bank Transfer", "Cash on Delivery"]
FIRST_NAMES = ["Anna", "John", "Maria", "Elias", "Sara", "Liam", "Noah", "Emma", "Oliver", "Sophia"]
LAST_NAMES = ["Smith", "Miller", "Brown", "Williams", "Johnson", "Davis", "Garcia", "Martinez"]
EMAIL_DOMAINS = ["gmail.com", "outlook.com", "yahoo.com"]
EMAIL_NUMBERS = 99            # 1..99 after the last name
DEFAULT_SIZES = {"customers": 10_000, "products": 500, "orders": 500_000,
                 "order_items": 1_500_000}

EMAIL_CAPACITY = len(FIRST_NAMES) * len(LAST_NAMES) * EMAIL_NUMBERS * len(EMAIL_DOMAINS)

def _u(seed: int, tag: str, id_col: str = "id") -> Column:
    """Uniform [0, 1) draw: 52 bits of the MD5 of seed, tag and row id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{tag}|"), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _int_between(seed, tag, lo, hi, id_col="id") -> Column:
    return (F.lit(lo) + F.floor(_u(seed, tag, id_col) * (hi - lo + 1))).cast("int")


def _money(seed, tag, lo, hi, id_col="id") -> Column:
    return F.round(F.lit(lo) + _u(seed, tag, id_col) * (hi - lo), 2).cast("decimal(10,2)")


def _choice(values: list[str], seed, tag, id_col="id") -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, _int_between(seed, tag, 1, len(values), id_col))


def _ts_lit(t: _dt.datetime) -> Column:
    """A wall-clock literal that no time zone shifts."""
    return F.lit(t.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def _past_ts(as_of: _dt.datetime, days: int, seed, tag, id_col="id") -> Column:
    secs = F.floor(_u(seed, tag, id_col) * (days * 86400 + 1)).cast("long")
    return _ts_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def _as_of(as_of) -> _dt.datetime:
    if as_of is None:
        return _dt.datetime.now().replace(microsecond=0)
    if isinstance(as_of, str):
        return _dt.datetime.fromisoformat(as_of)
    return as_of


def _coprime_step(n: int, seed: int) -> int:
    step = (seed * 2654435761 + 40503) % n or 1
    while math.gcd(step, n) != 1:
        step += 1
    return step


def customers(spark: SparkSession, n: int, seed: int = 42, as_of=None,
              num_partitions: int | None = None) -> DataFrame:
    """dim_customers 1..n with unique emails."""
    t0 = _as_of(as_of)
    # numbers after the last name go beyond 99 only where n needs more emails
    numbers = max(EMAIL_NUMBERS, -(-n // (EMAIL_CAPACITY // EMAIL_NUMBERS)))
    capacity = EMAIL_CAPACITY // EMAIL_NUMBERS * numbers
    step = _coprime_step(capacity, seed)
    df = spark.range(1, n + 1, numPartitions=num_partitions)
    p = F.pmod((F.col("id") - 1) * F.lit(step) + F.lit(seed), F.lit(capacity))
    nf, nl = len(FIRST_NAMES), len(LAST_NAMES)
    fn = F.element_at(F.array(*map(F.lit, FIRST_NAMES)), (F.pmod(p, nf) + 1).cast("int"))
    ln = F.element_at(F.array(*map(F.lit, LAST_NAMES)), (F.pmod(F.floor(p / nf), nl) + 1).cast("int"))
    num = (F.pmod(F.floor(p / (nf * nl)), numbers) + 1).cast("int")
    dom = F.element_at(F.array(*map(F.lit, EMAIL_DOMAINS)),
                       (F.floor(p / (nf * nl * numbers)) + 1).cast("int"))
    phone = F.format_string("(%d) %d-%d", _int_between(seed, "ph1", 100, 999),
                            _int_between(seed, "ph2", 100, 999),
                            _int_between(seed, "ph3", 1000, 9999))
    return df.select(
        F.col("id").cast("int").alias("customer_id"),
        F.concat_ws(" ", fn, ln).alias("customer_name"),
        F.concat(F.lower(fn), F.lit("."), F.lower(ln), num.cast("string"), F.lit("@"), dom)
        .alias("email"),
        phone.alias("phone"),
        _choice(COUNTRIES, seed, "country").alias("country"),
        _past_ts(t0, 1000, seed, "c_created").alias("created_at"))


def products(spark: SparkSession, n: int, seed: int = 42, as_of=None) -> DataFrame:
    """dim_products 1..n."""
    t0 = _as_of(as_of)
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("product_id"),
        F.concat(F.lit("Product "), F.col("id").cast("string"), F.lit(" - "),
                 _choice(CITIES, seed, "city")).alias("product_name"),
        _choice(PRODUCT_CATEGORIES, seed, "category").alias("category"),
        _money(seed, "price", 5.0, 1500.0).alias("unit_price"),
        _past_ts(t0, 500, seed, "p_created").alias("created_at"))


def _fk(n_parents: int, seed: int, tag: str) -> Column:
    """Uniform parent id in 1..n_parents."""
    return (F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(tag)), F.lit(n_parents)) + 1).cast("int")


def orders(spark: SparkSession, n: int, n_customers: int, seed: int = 42, as_of=None,
           num_partitions: int | None = None) -> DataFrame:
    """dim_orders 1..n; total_sales stays 0.00 (never rolled up)."""
    t0 = _as_of(as_of)
    return spark.range(1, n + 1, numPartitions=num_partitions).select(
        F.col("id").cast("int").alias("order_id"),
        _fk(n_customers, seed, "o_cust").alias("customer_id"),
        _choice(PAYMENT_METHODS, seed, "payment").alias("payment_method"),
        _past_ts(t0, 300, seed, "o_date").cast("date").alias("order_date"),
        F.lit(0).cast("decimal(12,2)").alias("total_sales"))


def order_items(spark: SparkSession, n: int, n_orders: int, n_products: int, seed: int = 42,
                as_of=None, num_partitions: int | None = None) -> DataFrame:
    """fact_order_items 1..n: quantity 1..10, price 5..1500, sales = q x price
    x uniform(0.9, 1.1) rounded to cents (G5)."""
    t0 = _as_of(as_of)
    q = _int_between(seed, "qty", 1, 10)
    price = _money(seed, "paid", 5.0, 1500.0)
    noise = F.lit(0.9) + _u(seed, "noise") * 0.2
    return spark.range(1, n + 1, numPartitions=num_partitions).select(
        F.col("id").alias("order_item_id"),
        _fk(n_orders, seed, "i_order").alias("order_id"),
        _fk(n_products, seed, "i_product").alias("product_id"),
        q.alias("quantity"),
        price.alias("unit_price_paid"),
        F.round(q * price.cast("double") * noise, 2).cast("decimal(12,2)").alias("line_item_sales"),
        _ts_lit(t0).alias("created_at"))


def shipments(items: DataFrame, seed: int = 42, as_of=None, fraction_den: int = 3,
              key: str = "order_item_id") -> DataFrame:
    """Shipments for an exact 1/``fraction_den`` sample of the items.

    shipping 5..50, pickup within 90 days, delivery 1..7 days later, 90 % on
    time, 1 % damaged. shipment_id reuses the (unique) item id: serial ids
    are not promised gap-free, and numbering a sample densely would need a
    global sort."""
    t0 = _as_of(as_of)
    n = items.count() // fraction_den
    s = sample_exact(items.select(key), n, [key], seed).withColumn("id", F.col(key))
    pickup = _past_ts(t0, 90, seed, "pickup").cast("date")
    return s.select(
        F.col(key).cast("bigint").alias("shipment_id"),
        F.col(key).cast("bigint").alias("order_item_id"),
        _money(seed, "ship", 5.0, 50.0).alias("shipping_cost"),
        pickup.alias("pickup_date"),
        F.date_add(pickup, _int_between(seed, "days", 1, 7)).alias("delivery_date"),
        (_u(seed, "ontime") < 0.9).alias("on_time_delivery"),
        (_u(seed, "damage") < 0.01).alias("damage_reported"),
        _ts_lit(t0).alias("created_at"))


def star(spark: SparkSession, sizes: dict | None = None, seed: int = 42, as_of=None) -> dict:
    """All five tables (lazy except the shipment sample's histogram jobs)."""
    z = {**DEFAULT_SIZES, **(sizes or {})}
    t0 = _as_of(as_of)
    c = customers(spark, z["customers"], seed, t0)
    p = products(spark, z["products"], seed, t0)
    o = orders(spark, z["orders"], z["customers"], seed, t0)
    i = order_items(spark, z["order_items"], z["orders"], z["products"], seed, t0)
    return {"dim_customers": c, "dim_products": p, "dim_orders": o,
            "fact_order_items": i, "fact_shipments": shipments(i, seed, t0)}


def write_star(spark: SparkSession, location: str, sizes: dict | None = None, seed: int = 42,
               as_of=None) -> dict[str, int]:
    """Generate and bulk-load (K4) the five tables under ``location/<table>``;
    returns the row count of each written table (read back from storage)."""
    from ..sinks.tables import bulk_load
    tables = star(spark, sizes, seed, as_of)
    counts = {}
    for name, df in tables.items():
        path = f"{location.rstrip('/')}/{name}"
        bulk_load(df, path)
        counts[name] = spark.read.parquet(path).count()
    return counts
