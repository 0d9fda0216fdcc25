"""Ticket states over time (L2, S7): an interval table and point-in-time lookup.

``intervals`` turns a log into one row per stretch of time in which a ticket's
state held: ``valid_from`` <= t < ``valid_to`` (NULL: to this day). A stretch ends with the
ticket's next CREATE or DELETE by (time, lsn). One scan in segments of (ticket, time, lsn) finds
every record's successor (``operators.scan.segmented``): the last record of a
segment takes the first of the ticket's next segment, which is one row per ticket and
segment, so a hot ticket is split like any other.

``write_history`` stores the table by ticket bucket. A ticket's stretches are cut into
pieces of PIECE in a row, and an index keeps where every piece begins. ``states_at``
answers any number of (ticket, time) points: a scan over the index and the points
alone finds each point's piece, and an equi-join on (ticket, piece) meets at most PIECE
stretches per point. So the work follows points plus pieces, however long one
ticket's history is, and only the buckets that the points name are read.

Records without a ticket id or a time are left out; a record that the next one
of its ticket follows at the same instant holds for no time and has no row. Points
without a ticket or a time find nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scan import SEGMENT, last_before, segmented
from ..sinks.bucketed import bucket_of
from ..sources.paths import path_exists
from .tickets import OPS

PIECE = 64
BUCKETS = 64
BUCKET = "bucket"
STATE = ["passenger_name", "created_at", "expires_at"]


def intervals(log: DataFrame, at: str = "created_at", segments: int | None = None) -> DataFrame:
    """(ticket_id, piece, valid_from, valid_to, passenger_name, created_at,
    expires_at): the stretches in which a ticket was there."""
    order = ["ticket_id", "_at", "lsn"]
    rows = segmented(log.where(F.col("op").isin(*OPS) & (F.length("ticket_id") > 0) & F.col(at).isNotNull())
                     .select("ticket_id", F.col(at).alias("_at"), "lsn", "op", *STATE), order, segments)
    own = Window.partitionBy(SEGMENT, "ticket_id").orderBy("_at", "lsn")
    # one row per ticket and segment
    firsts = rows.groupBy("ticket_id", SEGMENT).agg(F.min("_at").alias("_first"))
    following = firsts.select("ticket_id", SEGMENT, F.lead("_first").over(
        Window.partitionBy("ticket_id").orderBy(SEGMENT)).alias("_following"))
    held = (rows.withColumn("_next", F.lead("_at").over(own)).withColumn("_n", F.row_number().over(own) - 1)
            .join(following, ["ticket_id", SEGMENT]).withColumn("valid_to", F.coalesce("_next", "_following")))
    return (held.where((F.col("op") == "CREATE") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_at"))))
            .select("ticket_id", F.struct(F.col(SEGMENT).alias("segment"), F.floor(F.col("_n") / PIECE).alias("number"))
                    .alias("piece"), F.col("_at").alias("valid_from"), "valid_to", *STATE))


def write_history(log: DataFrame, path: str, at: str = "created_at", buckets: int = BUCKETS,
                  segments: int | None = None) -> None:
    """Store the intervals by ticket bucket and the index of their pieces."""
    spark = log.sparkSession
    rows = intervals(log, at, segments).withColumn(BUCKET, bucket_of("ticket_id", buckets))
    rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/intervals")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/intervals")
    # a piece's first row is written in one task, the groups are small
    (stored.groupBy(BUCKET, "ticket_id", "piece").agg(F.min("valid_from").alias("valid_from"))
     .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/index"))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def _named(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame | None:
    glob = f"{path}/{BUCKET}={{{','.join(map(str, sorted(buckets)))}}}"
    if not buckets or not path_exists(spark, glob):
        return None
    return spark.read.option("basePath", path).parquet(glob).drop(BUCKET)


def states_at(spark: SparkSession, path: str, points: DataFrame, id_col: str = "point_id",
              segments: int | None = None) -> DataFrame:
    """``points`` (id_col unique, ticket_id, ts) with the ticket's state at
    ts: passenger_name, created_at, expires_at, all NULL where there was no
    ticket."""
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    touched = [r.b for r in points.where(F.col("ticket_id").isNotNull())
               .select(bucket_of("ticket_id", buckets).alias("b")).distinct().collect()]    # at most `buckets` rows
    index, stored = _named(spark, f"{path}/index", touched), _named(spark, f"{path}/intervals", touched)
    asked = points.select(F.col(id_col).alias("_id"), "ticket_id", "ts")
    if index is None:
        none = {c: F.lit(None).cast("string") if c == "passenger_name" else F.lit(None).cast("timestamp_ntz")
                for c in STATE}
        return asked.withColumnsRenamed({"_id": id_col}).withColumns(none)
    rows = (index.select("ticket_id", F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), "piece")
            .unionByName(asked.select("ticket_id", F.col("ts").alias("_at"), F.lit(1).alias("_kind"), "_id"),
                         allowMissingColumns=True))
    # no two pieces of a ticket begin at one instant, and points are told apart by their id
    found = (last_before(rows, "ticket_id", ["_at", "_kind", "_id"], F.col("piece"), "_piece", segments)
             .where("_kind = 1").select("_id", "ticket_id", F.col("_at").alias("ts"), F.col("_piece").alias("piece")))
    inside = ((F.col("valid_from") <= F.col("ts")) & (F.col("valid_to").isNull() | (F.col("ts") < F.col("valid_to"))))
    hits = (found.join(stored, ["ticket_id", "piece"]).where(inside).select("_id", *STATE))
    return (asked.join(hits, "_id", "left").withColumnRenamed("_id", id_col))
