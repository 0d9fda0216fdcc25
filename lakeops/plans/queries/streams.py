"""Write paths end to end: the two streams and the full medallion run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ...sinks import keyed_table
from ...sinks.copy_text import read_copy, split_copy
from ...sinks.logs import append_log, publish_files
from ...sinks.tables import bulk_load
from ...sources import testdata as td
from ...sources.lines import numbered_lines
from ...streaming import orders as orders_stream
from ...streaming import replica as replica_stream
from .. import medallion
from ..orders import decode as decode_orders, split as split_orders
from .base import ORACLE_SQL, register, run_dir as _run_dir
from .match_events import AS_OF
from .order_messages import _MSG_SQL, INGEST_AS_OF
from .ticket_log import _LOG_SQL, _TICKETS_SQL, TICKET_TTL


# --------------------------------------------------------------------------
# Streaming jobs end to end: the records derived from events arrive as files
# in two batches (before / from the cut); the Structured Streaming query runs
# (availableNow) after each arrival; the query returns the resulting table.
# Each call works in a fresh folder under the session's checkpoint dir.
# --------------------------------------------------------------------------


STREAM_CUT = "2024-01-15 00:00:00"


def _cut(before: bool):
    c = F.lit(STREAM_CUT).cast("timestamp_ntz")
    return F.col("ts") < c if before else F.col("ts") >= c


@register("order_stream", f"""
SELECT order_uuid, username, item_name, quantity, TIMESTAMP '{INGEST_AS_OF}' AS created_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_uuid ORDER BY "offset") AS rn
      FROM ({_MSG_SQL}) m WHERE reject_reason IS NULL) x
WHERE rn = 1
""")
def q_order_stream(spark, d):
    run = _run_dir(spark, "order_stream")
    src, target, quar = f"{run}/in", f"{run}/orders", f"{run}/quarantine"
    for before in (True, False):
        # one write per arrival; each run of the stream picks up only the new files
        (td.order_messages(spark, d, _cut(before)).select("value")
         .write.mode("append").text(src))
        _drain(orders_stream.start_ingest(
            orders_stream.file_source(spark, src), target, quar,
            checkpoint=f"{run}/ckpt", trigger={"availableNow": True}, as_of=INGEST_AS_OF))
    return orders_stream.read_target(spark, target)


_FIRST_SQL = ORACLE_SQL["order_stream"]


@register("order_stream_one_batch", _FIRST_SQL)
def q_order_stream_one_batch(spark, d):
    """W1 with both arrivals, the later one written first, in one micro-batch:
    the messages' sequence decides, not the order of files."""
    run = _run_dir(spark, "order_stream_one_batch")
    src, target = f"{run}/in", f"{run}/orders"
    for before in (False, True):
        td.order_messages(spark, d, _cut(before)).select("value").write.mode("append").text(src)
    _drain(orders_stream.start_ingest(
        orders_stream.file_source(spark, src), target, f"{run}/quarantine", checkpoint=f"{run}/ckpt",
        trigger={"availableNow": True}, as_of=INGEST_AS_OF))
    return orders_stream.read_target(spark, target)


@register("order_table_keyed", f"""
SELECT order_uuid, username, item_name, quantity
FROM (SELECT *, row_number() OVER (PARTITION BY order_uuid ORDER BY "offset") AS rn
      FROM ({_MSG_SQL}) m WHERE reject_reason IS NULL) x
WHERE rn = 1
""")
def q_order_table_keyed(spark, d):
    """K3 into a table with a unique key, in two inserts of the same rows and a
    compaction between: each key once, from the first."""
    base = _run_dir(spark, "order_table")
    columns = ["order_uuid", "username", "item_name", "quantity"]
    for before in (True, False):
        good, _ = split_orders(decode_orders(td.order_messages(spark, d, None if not before else _cut(True)), ["offset"]))
        keyed_table.insert_ignore(good.select(*columns, "offset"), base, "order_uuid", ["offset"])
        keyed_table.compact(spark, base, "order_uuid", good.select(*columns, "offset").schema, most=0)
    return keyed_table.read(spark, base, good.select(*columns).schema)


@register("order_quarantine", f"""
SELECT "offset" AS seq, reject_reason FROM ({_MSG_SQL}) m WHERE reject_reason IS NOT NULL
""")
def q_order_quarantine(spark, d):
    """The rejected messages that the stream has put aside."""
    run = _run_dir(spark, "order_quarantine")
    td.order_messages(spark, d).select("value").write.text(f"{run}/in")
    _drain(orders_stream.start_ingest(
        orders_stream.file_source(spark, f"{run}/in"), f"{run}/orders", f"{run}/quarantine",
        checkpoint=f"{run}/ckpt", trigger={"availableNow": True}, as_of=INGEST_AS_OF))
    bad = spark.read.parquet(f"{run}/quarantine")
    return bad.select(F.get_json_object("value", "$.seq").cast("bigint").alias("seq"), "reject_reason")


@register("bulk_load", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
""")
def q_bulk_load(spark, d):
    """K4: rows appended in two loads, as Parquet, and read back."""
    path = f"{_run_dir(spark, 'bulk_load')}/orders"
    rows = td.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    odd = F.col("o_orderkey") % 2 == 1
    bulk_load(rows.where(odd), path)
    bulk_load(rows.where(~odd), path)
    return spark.read.parquet(path)


# events whose texts hold what the text form must escape: NULLs, empty texts, tabs,
# line ends and backslashes before letters
_COPY_SQL = """
SELECT event_id, ts, value,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN ''
            WHEN event_type = 'signup' THEN chr(92) || 'N'
            ELSE event_type || chr(9) || props || chr(92) || chr(92) || 't' || chr(10) || chr(13) || chr(92) END AS note
FROM events"""


def _copy_rows(spark, d):
    kind = F.col("event_type")
    note = (F.when(kind == "error", None).when(kind == "view", "").when(kind == "signup", "\\N")
            .otherwise(F.concat(kind, F.lit("\t"), F.col("props"), F.lit("\\\\t\n\r\\"))))
    return td.table(spark, d, "events").select("event_id", "ts", "value", note.alias("note"))


@register("bulk_load_text", _COPY_SQL)
def q_bulk_load_text(spark, d):
    """K4 in the tab-separated form, in two loads, and read back: every text,
    NULL and empty text is what it was."""
    path = f"{_run_dir(spark, 'bulk_load_text')}/events"
    rows = _copy_rows(spark, d)
    bulk_load(rows.where(_cut(True)), path, tsv=True)
    bulk_load(rows.where(_cut(False)), path, tsv=True)
    return read_copy(spark, path, rows.schema)


@register("bulk_load_bad_lines", f"""
SELECT CASE WHEN note IS NULL THEN 'wrong number of fields'
            WHEN note = chr(92) || 'N' THEN 'field 1 is no bigint' END AS reason, count(*) AS n
FROM ({_COPY_SQL}) c WHERE note IS NULL OR note = chr(92) || 'N' GROUP BY 1
""")
def q_bulk_load_bad_lines(spark, d):
    """K4 with foreign lines among the rows: those of errors lack a field, those of
    signups have a text for the id."""
    path = f"{_run_dir(spark, 'bulk_load_bad_lines')}/events"
    rows = _copy_rows(spark, d)
    bulk_load(rows.where("note IS NULL").drop("note"), path, tsv=True)
    named = F.concat(F.lit("id "), F.col("event_id").cast("string")).alias("event_id")
    bulk_load(rows.where("note = r'\\N'").select(named, "ts", "value", "note"), path, tsv=True)
    bulk_load(rows.where("note <> r'\\N'"), path, tsv=True)
    _, bad = split_copy(spark, path, rows.schema)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("published_orders", f"""
SELECT '{{"order_id":"' || order_uuid || '","user":"' || username || '","item":"' || item_name
       || '","quantity":' || coalesce(CAST(quantity AS VARCHAR), 'null') || '}}' AS value,
       count(*) OVER () AS published
FROM ({_MSG_SQL}) m
""")
def q_published_orders(spark, d):
    """K8: every order published as a JSON value into a folder that stands for
    the topic, with the number of messages that the write reported."""
    topic = f"{_run_dir(spark, 'published_orders')}/orders"
    rows = decode_orders(td.order_messages(spark, d)).select(
        F.col("order_uuid").alias("order_id"), F.col("username").alias("user"),
        F.col("item_name").alias("item"), "quantity")
    sent = publish_files(rows, topic)
    return spark.read.text(topic).select("value", F.lit(sent).cast("bigint").alias("published"))


def _drain(q):
    q.awaitTermination()
    if q.exception():
        raise q.exception()


_ISO_SQL = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"


@register("replica_sync", f"""
SELECT ticket_id, passenger_name, {_ISO_SQL.format(c="created_at")} AS created_at,
       {_ISO_SQL.format(c="expires_at")} AS expires_at
FROM (SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) AS rn
      FROM ({_LOG_SQL}) lg WHERE op IN ('CREATE', 'DELETE') AND length(ticket_id) > 0) x
WHERE rn = 1 AND op = 'CREATE'
""")
def q_replica_sync(spark, d):
    run = _run_dir(spark, "replica_sync")
    log_dir, base = f"{run}/wal", f"{run}/replica"
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    for i, before in enumerate((True, False)):
        recs = (td.ticket_log(spark, d, TICKET_TTL).withColumn("ts", F.col("created_at"))
                .where(_cut(before))
                .select(F.struct(F.lit(i).cast("bigint").alias("batch"),
                                 F.col("lsn").alias("seq")).alias("lsn"),
                        "op", "ticket_id", "passenger_name",
                        F.date_format("created_at", iso).alias("created_at"),
                        F.date_format("expires_at", iso).alias("expires_at")))
        append_log(recs, log_dir)
        _drain(replica_stream.start_sync(spark, log_dir, base,
                                         checkpoint=f"{run}/ckpt",
                                         trigger={"availableNow": True},
                                         query_name=f"replica_sync_{uuid.uuid4().hex[:8]}"))
    return replica_stream.current_tickets(spark, base)


def _log_lines(spark, d, path):
    """The ticket log as JSON lines without an lsn, in order, as several files."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    recs = td.ticket_log(spark, d, TICKET_TTL).orderBy("lsn").select(
        "lsn", F.to_json(F.struct("op", "ticket_id", "passenger_name", F.date_format("created_at", iso).alias("created_at"),
                                  F.date_format("expires_at", iso).alias("expires_at"),
                                  F.col("lsn").alias("event"))).alias("value"))
    recs.select("value").write.text(path)


@register("replica_follow", ORACLE_SQL["replica_sync"])
def q_replica_follow(spark, d):
    """L8 for one growing log file: it grows in three steps, the first two ending
    inside a line, and is followed after each."""
    run = _run_dir(spark, "replica_follow")
    _log_lines(spark, d, f"{run}/parts")
    for step in (1, 2, 3):
        td.one_file(spark, f"{run}/parts", f"{run}/wal.jsonl", step, 3)
        replica_stream.follow(spark, f"{run}/wal.jsonl", f"{run}/replica")
    return replica_stream.current_tickets(spark, f"{run}/replica")


@register("log_line_numbers", """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS line, event_id FROM events
""")
def q_log_line_numbers(spark, d):
    """The log's dense line numbers, over many files."""
    run = _run_dir(spark, "log_line_numbers")
    _log_lines(spark, d, f"{run}/log")
    return numbered_lines(spark, f"{run}/log").select(
        "line", F.get_json_object("value", "$.event").cast("long").alias("event_id"))


@register("replica_sync_now", f"""
SELECT count(*) AS tickets, (SELECT count(*) FROM ({_LOG_SQL}) lg WHERE op IN ('CREATE', 'DELETE')) AS records
FROM ({_TICKETS_SQL}) t
""")
def q_replica_sync_now(spark, d):
    """The whole log replayed in one go, and the count that the
    call returns."""
    run = _run_dir(spark, "replica_sync_now")
    recs = (td.ticket_log(spark, d, TICKET_TTL).where(F.col("op").isin("CREATE", "DELETE"))
            .select(F.struct(F.lit(0).cast("bigint").alias("batch"), F.col("lsn").alias("seq")).alias("lsn"),
                    "op", "ticket_id", "passenger_name"))
    append_log(recs, f"{run}/wal")
    n = replica_stream.sync_now(spark, f"{run}/wal", f"{run}/replica")
    return recs.agg(F.lit(n).cast("bigint").alias("tickets"), F.count(F.lit(1)).alias("records"))


@register("medallion_run", ORACLE_SQL["layer_counts"])
def q_medallion_run(spark, d):
    """M1-M4 with the writes: bronze and silver by full refresh into fixed
    schemas, gold by create-as-select, counts observed while writing."""
    run = _run_dir(spark, "medallion")
    return medallion.run(td.match_events(spark, d), run, as_of=AS_OF)
