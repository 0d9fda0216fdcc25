"""Reports kept up to date from new files only.

A kept report stores mergeable partial aggregates (counts, sums, least and
largest values, distinct keys) by key in buckets (``sinks.bucketed``). ``update`` lists the
source folder, reads the files that were not folded yet, aggregates them, and
merges the result into the buckets it touches; all other buckets and files stay
unread. The report itself is computed from the stored aggregates, which are as many as
keys, not rows.

Which files are in is stored beside each version; a version counts once its manifest is
renamed into place, so an update that died is made again as a whole and folds nothing
twice. Files of the source are never changed or removed once written (a folder that is
appended to): a folded file that is gone or has another length stops the update,
because a least value can't be taken back. One writer per kept report; readers see the last
version whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.topk import top_k
from ..sinks import bucketed
from ..sources.paths import path_exists
from . import medallion

BUCKETS = 64
KEY = "_key"
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Kept:
    """``keys`` of the stored rows; ``values``: name -> (how to merge, the
    partial aggregate of rows, in SQL); ``prepare``: source rows to rows with the keys."""
    keys: tuple[str, ...]
    values: dict[str, tuple[str, str]] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df

    def partial(self, rows: DataFrame) -> DataFrame:
        g = self.prepare(rows).groupBy(*self.keys)
        aggregates = [F.expr(v).alias(n) for n, (_, v) in self.values.items()] or [F.count(F.lit(1)).alias("_rows")]
        out = g.agg(*aggregates).drop("_rows")
        key = F.xxhash64(*self.keys) if self.keys else F.lit(0).cast("long")
        return _steady(out.withColumn(KEY, key))

    def merged(self, rows: DataFrame) -> DataFrame:
        by = [KEY, *self.keys]
        if not self.values:
            return rows.select(*by).distinct()
        return _steady(rows.groupBy(*by).agg(*[_MERGE[how](n).alias(n) for n, (how, _) in self.values.items()]))


def _steady(rows: DataFrame) -> DataFrame:
    """Decimals as wide as they get: a sum of sums would be of another type
    at each merge."""
    wide = {f.name: F.col(f"`{f.name}`").cast(T.DecimalType(38, f.dataType.scale)) for f in rows.schema
            if isinstance(f.dataType, T.DecimalType)}
    return rows.withColumns(wide) if wide else rows


def _listing(spark: SparkSession, source: str) -> DataFrame:
    """(path, length) of the source's files; their contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(source).select("path", "length"))


def _files(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/files/v={version:020d}"


def folded(spark: SparkSession, base: str) -> DataFrame:
    """(path, length) of the files in the current version."""
    version, _, _ = bucketed.current(spark, base, BUCKETS)
    if version < 0:
        return spark.createDataFrame([], "path string, length long")
    return (spark.read.schema("path string, length long, v string").parquet(f"{base.rstrip('/')}/files")
            .where(F.col("v").cast("decimal(20,0)") <= version).select("path", "length"))


def state(spark: SparkSession, base: str, kept: Kept, schema) -> DataFrame:
    """The stored aggregates; ``schema`` is that of the source."""
    _, _, entries = bucketed.current(spark, base, BUCKETS)
    return bucketed.read(spark, base, _stored(spark, kept, schema), entries).drop(KEY)


def _stored(spark: SparkSession, kept: Kept, schema) -> str:
    rows = kept.merged(kept.partial(spark.createDataFrame([], schema)))
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def update(spark: SparkSession, base: str, kept: Kept, source: str, schema) -> int:
    """Fold the files of ``source`` that are not in yet; their number. A
    missing source has no files."""
    if not path_exists(spark, source):
        return 0
    listing, before = _listing(spark, source), folded(spark, base)
    lost = before.join(listing, ["path", "length"], "left_anti").first()
    if lost is not None:
        raise ValueError(f"{lost.path} was folded and is gone or changed: rebuild {base}")
    new = listing.join(before, "path", "left_anti").persist()
    try:
        paths = [r.path for r in new.select("path").collect()]      # the names of new files only
        if not paths:
            return 0
        version, buckets, entries = bucketed.current(spark, base, BUCKETS if kept.keys else 1)
        new.write.mode("overwrite").parquet(_files(base, version + 1))
        rows = kept.partial(spark.read.schema(schema).parquet(*paths)).persist()
        try:
            touched = [r.b for r in rows.select(bucketed.bucket_of(KEY, buckets).alias("b")).distinct().collect()]
            stored = bucketed.read(spark, base, _stored(spark, kept, schema), entries, set(touched))
            bucketed.write(kept.merged(stored.unionByName(rows)), base, KEY, version + 1, buckets, entries, touched)
        finally:
            rows.unpersist()
        return len(paths)
    finally:
        new.unpersist()


# ---------------------------------------------------------------- the reports

ROWS = Kept((), {"n": ("sum", "count(1)")})
SALES = Kept((), {"total": ("sum", "sum(line_item_sales)"), "n": ("sum", "count(line_item_sales)")})
PRODUCTS = Kept(("product_id",), {"qty": ("sum", "sum(quantity)")})
SHIPMENTS = Kept((), {"least": ("min", "min(shipping_cost)"), "most": ("max", "max(shipping_cost)"),
                      "total": ("sum", "sum(shipping_cost)"), "costs": ("sum", "count(shipping_cost)"),
                      "hits": ("sum", "count_if(on_time_delivery)"), "n": ("sum", "count(1)")})
CUSTOMERS = Kept(("customer_id",), {"n": ("sum", "count(order_id)")})


def silver_keys(as_of=None) -> Kept:
    """The distinct silver rows: what gold counts."""
    return Kept(("match_id", "team", "event_type", "timestamp"),
                prepare=lambda source: medallion.silver(medallion.bronze(source), as_of))


def row_count(s: DataFrame, name: str) -> DataFrame:
    return s.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def avg_sales(s: DataFrame) -> DataFrame:
    return s.agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("average_line_item_sales"))


def top_products(s: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    by_name = (s.join(products.select("product_id", "product_name"), "product_id").groupBy("product_name")
               .agg(F.sum("qty").alias("total_quantity_sold")))
    return top_k(by_name, n, [F.desc("total_quantity_sold"), F.asc("product_name")])


def shipment_stats(s: DataFrame) -> DataFrame:
    return s.agg(F.min("least").alias("min_cost"), F.max("most").alias("max_cost"),
                 (F.sum("total") / F.nullif(F.sum("costs"), F.lit(0))).alias("avg_cost"),
                 (F.sum("hits").cast("decimal(20,0)") * 100 / F.nullif(F.sum("n"), F.lit(0))).alias("on_time_rate_percent"))


def orders_by_country(s: DataFrame, customers: DataFrame) -> DataFrame:
    return (s.join(customers.select("customer_id", "country"), "customer_id").groupBy("country")
            .agg(F.sum("n").cast("bigint").alias("total_orders"))
            .orderBy(F.desc("total_orders"), F.asc_nulls_first("country")))


def gold(s: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    return medallion.gold(s, patterns)
