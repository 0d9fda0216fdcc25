"""Continuous order ingest, first record per order id across all
history, as a Structured Streaming query.

Default form (``foreachBatch``): each micro-batch is decoded, bad rows go to
a quarantine table, the first record per order id in the batch is chosen by
(partition, offset) -- or by file position for file sources -- and only ids
absent from the target are appended. The target, not operator state, holds
the history, so state does not grow with the number of ids; keep the target
bucketed/partitioned by ``order_uuid`` hash at scale so the anti-join reads
only matching buckets. A retried batch appends nothing the second time (the
anti-join sees its first attempt); quarantine rows are written per batch id
with dynamic overwrite, so retries replace them. One writer is assumed.

The target is stored partitioned by ``order_bucket = pmod(xxhash64(order_uuid), B)``
(B = 64 by default). A micro-batch collects the buckets its ids fall in (at
most B values) and reads only those folders of the target (static partition
pruning), so the per-batch cost follows the buckets it touches instead of the
whole history; with small batches and a larger B most of the target is
never read. ``buckets=None`` keeps a flat target.

Which record is first: inside a micro-batch the one of the smallest sequence number
(``seq``), or for want of it the oldest file; across micro-batches the one whose batch
came first, because a stored row is never replaced. So with ``maxFilesPerTrigger`` a message
of a smaller ``seq`` in a later batch does not displace a stored one. Where event time must
decide over any split into batches, use ``streaming.keyed.first_wins``; where several
writers share the target, or it must stay compact while it grows, ``sinks.keyed_table``.

Option (``dedup_state``): native ``dropDuplicates`` with keyed state; simple
but the state grows with every id ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.joins import MAX_PROBE_BYTES
from ..plans import orders
from ..session import shared_path
from ..sinks.logs import kafka_options
from ..sources.paths import path_exists


def kafka_source(spark: SparkSession, bootstrap: str, topic: str,
                 group_id: str | None = None) -> DataFrame:
    """S3: the topic from the earliest offset (needs the Kafka connector). Lost
    offsets stop the query: the default of ``failOnDataLoss``."""
    extra = {"subscribe": topic, "startingOffsets": "earliest"}
    if group_id:
        extra["kafka.group.id"] = group_id
    opts = kafka_options(bootstrap, topic, extra)
    opts.pop("topic")
    return spark.readStream.format("kafka").options(**opts).load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of JSON-lines files as a message stream (``value``, and where
    it stood, used for first-wins order)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("value", F.col("_metadata.file_modification_time").alias("_time"),
                               F.col("_metadata.file_path").alias("_file"),
                               F.col("_metadata.file_block_start").alias("_start"))


def _with_order(batch: DataFrame) -> tuple[DataFrame, list[str]]:
    if "offset" in batch.columns and "partition" in batch.columns:
        return batch, ["partition", "offset"]
    # file source: the message's own sequence number, if it carries one (a
    # writer of several files per arrival needs it: their times follow the
    # tasks); else file time, file, and row position (row ids grow with the
    # split order inside a batch, which is by size, so the split's start counts)
    none = {"_time": F.lit(None).cast("timestamp"), "_file": F.lit(""), "_start": F.lit(0).cast("bigint")}
    place = [(F.col(c) if c in batch.columns else none[c]).alias(c) for c in none]
    seq = F.get_json_object("value", f"$.{SEQUENCE}").try_cast("bigint")
    ordered = batch.withColumn("value", F.col("value").cast("string")).select(
        "value", F.coalesce(seq, F.lit(2 ** 63 - 1)).alias("_seq"), *place,
        F.monotonically_increasing_id().alias("_row"))
    return ordered, ["_seq", *none, "_row"]


SEQUENCE = "seq"            # top-level field of a message that orders arrivals
BUCKET_COL = "order_bucket"
DEFAULT_BUCKETS = 64


def bucket_of(col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


_STORED = T.StructType(schemas.ORDERS_TARGET.fields + [T.StructField(BUCKET_COL, T.IntegerType())])


def _stored_keys(spark: SparkSession, target: str, touched: list[int]) -> DataFrame | None:
    """Keys stored in the touched buckets only: a glob over those folders and
    a declared schema, so neither the other folders nor file footers are read.
    None if no such folder exists; a read that fails is raised."""
    glob = f"{target.rstrip('/')}/{BUCKET_COL}={{{','.join(str(b) for b in sorted(touched))}}}"
    if not path_exists(spark, glob):
        return None
    return (spark.read.schema(_STORED).option("basePath", target).parquet(glob)
            .select(*orders.KEY))


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The orders table without the storage bucket column."""
    df = spark.read.parquet(target)
    return df.drop(BUCKET_COL) if BUCKET_COL in df.columns else df


def process_batch(batch: DataFrame, epoch_id: int, target: str, quarantine: str,
                  as_of=None, buckets: int | None = DEFAULT_BUCKETS) -> None:
    spark = batch.sparkSession
    msgs, order_cols = _with_order(batch)
    decoded = orders.decode(msgs, order_cols).persist()
    try:
        ok, bad = orders.split(decoded)
        (bad.select("value", "reject_reason", F.lit(int(epoch_id)).alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(quarantine))
        ok = ok.where(F.col("order_uuid").isNotNull())
        # one small job over the persisted batch: touched buckets and size
        per_bucket = (ok.groupBy(bucket_of("order_uuid", buckets or 1).alias("b"))
                      .agg(F.sum(F.octet_length("order_uuid") + 32).alias("bytes"))
                      .collect())                                   # at most `buckets` rows
        if not per_bucket:
            return
        small = sum(r["bytes"] for r in per_bucket) <= MAX_PROBE_BYTES
        if buckets:
            existing = _stored_keys(spark, target, [r["b"] for r in per_bucket])
        else:
            existing = (spark.read.schema(schemas.ORDERS_TARGET).parquet(target).select(*orders.KEY)
                        if path_exists(spark, target) else None)
        add = orders.rows_to_insert_target(ok, existing, order_cols, as_of, small)
        if buckets:
            # rebalanced by bucket: AQE merges the small buckets of a small batch
            # into few tasks and splits those of a backfill into many
            add = add.withColumn(BUCKET_COL, bucket_of("order_uuid", buckets))
            (add.hint("rebalance", BUCKET_COL)
             .write.mode("append").partitionBy(BUCKET_COL).parquet(target))
        else:
            add.write.mode("append").parquet(target)
    finally:
        decoded.unpersist()


def start_ingest(source: DataFrame, target: str, quarantine: str,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 as_of=None, query_name: str | None = None,
                 buckets: int | None = DEFAULT_BUCKETS) -> StreamingQuery:
    """Start W1 with ``foreachBatch``. ``trigger`` e.g. ``{"availableNow": True}``
    or ``{"processingTime": "1 second"}``. The checkpoint defaults to a folder
    under the session's shared ``spark.checkpoint.dir``."""
    spark = source.sparkSession
    ckpt = checkpoint or shared_path(spark, "streams", query_name or "orders_ingest")
    w = (source.writeStream
         .foreachBatch(lambda df, eid: process_batch(df, eid, target, quarantine, as_of,
                                                     buckets))
         .option("checkpointLocation", ckpt))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    return w.start()


def dedup_state(source: DataFrame, watermark_col: str | None = None,
                delay: str | None = None) -> DataFrame:
    """Option B: native keyed-state dedup of decoded good rows. With a
    watermark, ``dropDuplicatesWithinWatermark`` bounds state but only
    drops duplicates that arrive within the delay (weaker than W1)."""
    keep = [watermark_col] if watermark_col else []
    ok, _ = orders.split(orders.decode(source, keep))
    if watermark_col and delay:
        return ok.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(orders.KEY)
    return ok.dropDuplicates(orders.KEY)


def compact_target(spark: SparkSession, target: str, out: str) -> int:
    """Rewrite a bucketed target into ``out`` with one file per bucket (the
    small files of many micro-batches merged). Spark cannot overwrite a path
    it reads, so the copy goes elsewhere; point readers (and the next stream
    run, with the same checkpoint) at ``out`` once it is written. Ids are
    unique, so buckets are balanced. Returns the row count, checked against
    the source."""
    src = spark.read.parquet(target)
    src.repartition(BUCKET_COL).write.mode("errorifexists").partitionBy(BUCKET_COL).parquet(out)
    n_src, n_out = src.count(), spark.read.parquet(out).count()
    if n_src != n_out:
        raise RuntimeError(f"compaction lost rows: {n_src} -> {n_out}")
    return n_out
