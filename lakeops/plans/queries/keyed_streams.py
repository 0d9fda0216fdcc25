"""Keyed streams in event time: live validation, expiry, option B of W1. The
rows derived from ``events`` arrive in ARRIVALS portions by time; each portion
is several files and the stream is stopped after it and started again from its
checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...sources import testdata as td
from ...streaming import keyed
from .base import register, run_dir
from .order_messages import _MSG_SQL
from .streams import _drain
from .ticket_log import _COUNTING_SQL, _JOINED_SQL, TICKET_TTL, _finish_sql

ARRIVALS = 3
FILE_ROWS = 100_000


def arrivals(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with the number of their portion of the time they span, and
    the microseconds of a portion."""
    at = F.unix_micros("at")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // ARRIVALS))
    return rows.withColumn("portion", F.floor((at - F.lit(low or 0)) / F.lit(width))), width


def run_stream(spark, name: str, rows: DataFrame, make, tick: dict, files: int = 4) -> DataFrame:
    """Rows into files, portion by portion, each followed by a run of the
    stream ``make(source, delay)``; at last a tick far enough ahead to settle all
    rows. A portion's rows are in no order, so the delay covers a portion. A portion
    has ``files`` files, more if they would hold over FILE_ROWS rows, and a
    micro-batch takes three quarters of them: more rows are read by more tasks."""
    run = run_dir(spark, name)
    dealt, width = arrivals(rows)
    dealt.write.partitionBy("portion").parquet(f"{run}/dealt")
    dealt = spark.read.parquet(f"{run}/dealt")
    last, n = dealt.agg(F.max("at"), F.count(F.lit(1))).first()
    files = max(files, -(-n // (ARRIVALS * FILE_ROWS)))

    def arrive(df):
        df.write.mode("append").parquet(f"{run}/in")
        source = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, files * 3 // 4))
                  .parquet(f"{run}/in"))
        q = keyed.start(make(source, f"{-(-width // 1000) + 1} milliseconds"), f"{run}/out", f"{run}/checkpoint",
                        {"availableNow": True})
        _drain(q)

    for portion in range(ARRIVALS):
        arrive(dealt.where(F.col("portion") == portion).drop("portion").repartition(files))
    if last is not None:
        ahead = F.lit(last) + F.expr(f"INTERVAL {width // 1_000_000 + 2 * 86_400 * 366} SECONDS")
        cells = [(ahead if f.name == "at" else F.lit(tick[f.name]) if f.name in tick else F.lit(None))
                 .cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        arrive(spark.range(1).select(*cells))
    return keyed.results(spark, f"{run}/out")


_TICK = {"ticket": "", "at_us": 0, "id": 0, "kind": keyed.TICK}


@register("validate_live", _finish_sql(_JOINED_SQL))
def q_validate_live(spark, d):
    """L5 on a stream of log records and requests, with keyed state."""
    rows = keyed.record_rows(td.ticket_log(spark, d, TICKET_TTL)).unionByName(
        keyed.request_rows(td.ticket_requests(spark, d)))
    return run_stream(spark, "validate_live", rows, keyed.live_validation, _TICK)


@register("expiry_timers", f"""
SELECT 'DELETE' AS op, ticket_id, expires_at AS expired_at
FROM (SELECT *, lead(created_at) OVER (PARTITION BY ticket_id ORDER BY created_at, lsn) AS following
      FROM ({_COUNTING_SQL}) c) l
WHERE op = 'CREATE' AND (following IS NULL OR expires_at < following)
""")
def q_expiry_timers(spark, d):
    """L4 by event-time timers: every expiry that passes while the ticket is
    current, over the whole log."""
    rows = keyed.record_rows(td.ticket_log(spark, d, TICKET_TTL))
    return run_stream(spark, "expiry_timers", rows, keyed.expiries, _TICK)


@register("order_stream_keyed_state", f"""
SELECT order_uuid, username, item_name, quantity, ts AS at
FROM (SELECT *, row_number() OVER (PARTITION BY order_uuid ORDER BY ts, "offset") AS rn
      FROM ({_MSG_SQL}) m WHERE reject_reason IS NULL) x
WHERE rn = 1
""")
def q_order_stream_keyed_state(spark, d):
    """W1 option B: first record per order id by keyed state alone."""
    at = td.table(spark, d, "events").select(F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("at"))
    rows = (td.order_messages(spark, d).join(at, "offset")
            .select("value", "at", F.col("offset").alias("id")))
    tick = {"value": '{"order_id": "-", "user": "-", "item": "-", "quantity": 0}', "id": 0}
    found = run_stream(spark, "order_stream_keyed_state", rows, keyed.first_wins, tick)
    return found.where("order_uuid <> '-'")
