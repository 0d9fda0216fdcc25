"""Order messages in batch form, and JSON decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.exprs import coerce_int, json_field
from ...operators.dedup import first_per_key
from ...sources import testdata as td
from .. import orders
from .base import register


# --------------------------------------------------------------------------
# Order stream (batch form): decode + coercion + quarantine, first wins,
# insert-or-ignore against an existing target
# --------------------------------------------------------------------------

ORDERS_CUT_TARGET = "2024-01-15 00:00:00"   # existing table: events before this
ORDERS_CUT_NEW = "2024-01-14 00:00:00"      # incoming batch: events from this (one day overlaps)
INGEST_AS_OF = "2024-02-01 00:00:00"

_MSG_SQL = """
SELECT event_id AS "offset", ts,
       'order-' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS order_uuid,
       'user' || CAST(user_id AS VARCHAR) AS username,
       event_type AS item_name,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_type = 'signup' THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
            ELSE CAST(ROUND(value) AS INTEGER) END AS quantity,
       CASE WHEN event_type = 'error' THEN 'bad quantity' END AS reject_reason
FROM events
"""


@register("order_decode", f"""
SELECT "offset", order_uuid, username, item_name, quantity, reject_reason FROM ({_MSG_SQL}) m
""")
def q_order_decode(spark, d):
    return orders.decode(td.order_messages(spark, d), ["offset"]).drop("value")


@register("first_wins", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) x
WHERE rn = 1
""")
def q_first_wins(spark, d):
    return first_per_key(td.table(spark, d, "events"), ["user_id"], ["event_id"])


@register("insert_ignore", f"""
WITH m AS ({_MSG_SQL}),
tgt AS (SELECT order_uuid FROM m WHERE ts < TIMESTAMP '{ORDERS_CUT_TARGET}' AND reject_reason IS NULL),
nw AS (SELECT * FROM (
         SELECT *, row_number() OVER (PARTITION BY order_uuid ORDER BY "offset") AS rn
         FROM m WHERE ts >= TIMESTAMP '{ORDERS_CUT_NEW}' AND reject_reason IS NULL) x
       WHERE rn = 1)
SELECT order_uuid, username, item_name, quantity, TIMESTAMP '{INGEST_AS_OF}' AS created_at
FROM nw WHERE order_uuid NOT IN (SELECT order_uuid FROM tgt)
""")
def q_insert_ignore(spark, d):
    ts = F.col("ts")
    existing_msgs = td.order_messages(spark, d, ts < F.lit(ORDERS_CUT_TARGET).cast("timestamp_ntz"))
    existing = orders.accepted_keys(existing_msgs, ["offset"])       # the stored table's ids
    new_msgs = td.order_messages(spark, d, ts >= F.lit(ORDERS_CUT_NEW).cast("timestamp_ntz"))
    return orders.orders_to_insert(new_msgs, existing, ["offset"], as_of=INGEST_AS_OF)


@register("json_decode", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_decode(spark, d):
    """P13 + P18: a field of a JSON text column, typed as an integer."""
    e = td.table(spark, d, "events")
    return e.select("event_id", coerce_int(json_field("props", "k")).alias("k"))
