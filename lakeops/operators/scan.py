"""Ordered scans that no single task has to make: a running maximum over a
total order, and the last record of a key before each row.

Spark has no distributed running aggregate: a window without PARTITION BY
runs in one task, and a window by key puts a hot key in one task. Both scans
cut the rows into segments of their total order first. ``segmented`` range-
partitions on the order key, which must be unique, so segments stay balanced
even if one instant or one key holds a third of all rows, and writes the rows with
their segment's number into the shared folder. Everything after that reads those
files: segment numbers can't disagree between readers, whatever the planner
reuses, coalesces or runs again.

Each segment is then scanned on its own, its total goes forward over the
segments (one row per segment, or per key and segment), and the two meet by a
join on the segment.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path

SEGMENT = "_segment"
SEGMENT_BYTES = 128 << 20
_BEFORE = (Window.unboundedPreceding, -1)


def segments_for(df: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> int:
    """Segments of about ``segment_bytes`` of what the plan reads, and at least
    ``spark.sql.shuffle.partitions``. The sizes are those of the plan's leaves: the
    estimate of a join's result is a product, far above what comes out. A session that
    shows no plan (a remote one) gets ``spark.sql.shuffle.partitions``."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not hasattr(df, "_jdf"):
        return floor
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(floor, min(-(-size // segment_bytes), 100_000))


def segmented(df: DataFrame, order_cols: list[str], segments: int | None = None) -> DataFrame:
    """``df`` with its segment's number, written once and read back. Segments
    are ranges of ``order_cols``, numbered in that order."""
    spark = df.sparkSession
    n = segments or segments_for(df)
    out = df.repartitionByRange(n, *order_cols).withColumn(SEGMENT, F.spark_partition_id())
    path = shared_path(spark, "lakeops-segments", uuid.uuid4().hex)
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def exclusive_running_max(df: DataFrame, order_cols: list[str], value_col: str,
                          out_col: str, segments: int | None = None) -> DataFrame:
    """Add ``out_col`` = max(``value_col``) over rows ordered strictly before
    this one by ``order_cols`` (which must be unique). NULL values are
    skipped; no earlier value gives NULL."""
    rows = segmented(df, order_cols, segments)
    own = Window.partitionBy(SEGMENT).orderBy(*order_cols).rowsBetween(*_BEFORE)
    totals = rows.groupBy(SEGMENT).agg(F.max(value_col).alias("_total"))
    # one row per segment
    ahead = totals.select(SEGMENT, F.max("_total").over(
        Window.orderBy(SEGMENT).rowsBetween(*_BEFORE)).alias("_ahead"))
    return (rows.withColumn("_own", F.max(value_col).over(own)).join(ahead, SEGMENT)
            .withColumn(out_col, F.greatest("_own", "_ahead"))
            .drop("_own", "_ahead", SEGMENT))


def last_before(df: DataFrame, key: str, order_cols: list[str], record: Column,
                out_col: str, segments: int | None = None) -> DataFrame:
    """Add ``out_col`` = the last non-NULL ``record`` of the same key among
    the rows ordered strictly before this one (NULL if there is none).
    ``order_cols`` must be unique within a key."""
    rows = segmented(df.withColumn("_record", record), [key, *order_cols], segments)
    own = Window.partitionBy(SEGMENT, key).orderBy(*order_cols).rowsBetween(*_BEFORE)
    at = F.struct(*[F.col(c) for c in order_cols])
    # one row per key and segment: a key's rows fill few segments unless it is hot
    totals = rows.groupBy(key, SEGMENT).agg(
        F.max_by("_record", F.when(F.col("_record").isNotNull(), at)).alias("_total"))
    ahead = totals.select(F.col(key).alias("_ahead_key"), SEGMENT, F.last("_total", ignorenulls=True).over(
        Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(*_BEFORE)).alias("_ahead"))
    ahead = ahead.where(F.col("_ahead").isNotNull()).withColumnRenamed(SEGMENT, "_ahead_segment")
    return (rows.withColumn("_own", F.last("_record", ignorenulls=True).over(own))
            .join(ahead, F.col(key).eqNullSafe(F.col("_ahead_key")) & (F.col(SEGMENT) == F.col("_ahead_segment")), "left")
            .withColumn(out_col, F.coalesce("_own", "_ahead"))
            .drop("_own", "_ahead", "_ahead_key", "_ahead_segment", "_record", SEGMENT))
