"""L1-L7, L10 ticket log over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.exprs import format_iso, parse_iso
from ...sinks.logs import append_validation_lines
from ...sources import testdata as td
from ...sources.jsonlog import bad_records, parse_records, read_log, read_text_or_empty
from .. import history, tickets
from .base import register, run_dir


# --------------------------------------------------------------------------
# L1-L7, L10 ticket log over events (signup/purchase = CREATE, error = DELETE,
# click/view = validation requests, user id = ticket id, one-day tickets)
# --------------------------------------------------------------------------

TICKET_TTL = "1 day"
_TTL_SQL = "INTERVAL 1 DAY"

_LOG_SQL = f"""
SELECT event_id AS lsn,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'CREATE'
            WHEN event_type = 'error' THEN 'DELETE' ELSE upper(event_type) END AS op,
       CAST(user_id AS VARCHAR) AS ticket_id,
       'passenger ' || CAST(user_id AS VARCHAR) AS passenger_name,
       ts AS created_at, ts + {_TTL_SQL} AS expires_at
FROM events
"""
_COUNTING_SQL = f"SELECT * FROM ({_LOG_SQL}) lg WHERE op IN ('CREATE', 'DELETE') AND length(ticket_id) > 0"


def _replayed_sql(where: str = "TRUE") -> str:
    return f"""
SELECT ticket_id, passenger_name, created_at, expires_at FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) AS rn
  FROM ({_COUNTING_SQL}) c WHERE {where}) x
WHERE rn = 1 AND op = 'CREATE'
"""


_TICKETS_SQL = _replayed_sql()
# the end of the log, and the middle of the time it spans, both from the data
_END_SQL = "(SELECT max(ts) FROM events)"
_MIDDLE_SQL = ("(SELECT make_timestamp(epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) "
               "FROM events)")
_REQ_SQL = """
SELECT event_id AS request_id, CAST(user_id AS VARCHAR) AS ticket_id, ts
FROM events WHERE event_type IN ('click', 'view')
"""
# the state at a request's time: the last record ahead of it by (time, id)
_POS = "epoch_us({t})::HUGEINT * 1000000000000 + {i}"
_JOINED_SQL = f"""
SELECT r.request_id, r.ticket_id, r.ts, t.passenger_name AS tn, t.expires_at AS te,
       CASE WHEN t.op IS NULL OR t.op = 'DELETE' THEN 'not_found'
            WHEN r.ts <= t.expires_at THEN 'valid' ELSE 'expired' END AS status
FROM (SELECT *, {_POS.format(t="ts", i="request_id")} AS pos FROM ({_REQ_SQL}) q) r
ASOF LEFT JOIN (SELECT *, {_POS.format(t="created_at", i="lsn")} AS pos FROM ({_COUNTING_SQL}) c) t
  ON r.ticket_id = t.ticket_id AND r.pos >= t.pos
"""


def _finish_sql(src: str, status: str = "status") -> str:
    return f"""
SELECT request_id, ticket_id, ts, {status} AS status,
       CASE WHEN {status} = 'valid' THEN tn END AS passenger_name,
       CASE WHEN {status} = 'valid' THEN te END AS expires_at
FROM ({src}) v
"""


def _swept_sql(trigger: str) -> str:
    prev = f"""
SELECT *, MAX({trigger}) OVER (ORDER BY ts, request_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
FROM ({_JOINED_SQL}) j
"""
    return _finish_sql(prev, "CASE WHEN status = 'expired' AND prev > te THEN 'not_found' "
                             "ELSE status END")


def _log(spark, d):
    return td.ticket_log(spark, d, TICKET_TTL)


def _with_time(df, spark, d, time):
    """``df`` beside one point in time (one row) taken from the whole log."""
    return df.crossJoin(td.table(spark, d, "events").agg(time.alias("_as_of")))


def _middle(ts):
    """The middle of the time span, in whole microseconds."""
    low, high = F.unix_micros(F.min(ts)), F.unix_micros(F.max(ts))
    return F.timestamp_micros(low + F.floor((high - low) / 2)).cast("timestamp_ntz")


@register("ticket_replay", _TICKETS_SQL)
def q_ticket_replay(spark, d):
    """L2 over the whole log."""
    return tickets.replay(_log(spark, d))


@register("ticket_state_mid_month", _replayed_sql(f"created_at <= {_MIDDLE_SQL}"))
def q_ticket_state_mid_month(spark, d):
    """L2 as of the middle of the time that the log spans (point-in-time fold
    over the whole log)."""
    log = _with_time(_log(spark, d), spark, d, _middle(F.col("ts").cast("timestamp")))
    return tickets.replay_as_of(log, F.col("_as_of"))


@register("ticket_state_at_times", f"""
SELECT r.request_id, r.ticket_id, r.ts, CASE WHEN t.op = 'CREATE' THEN t.passenger_name END AS passenger_name,
       CASE WHEN t.op = 'CREATE' THEN t.created_at END AS created_at,
       CASE WHEN t.op = 'CREATE' THEN t.expires_at END AS expires_at
FROM (SELECT *, {_POS.format(t="ts", i="999999999999")} AS pos FROM ({_REQ_SQL}) q) r
ASOF LEFT JOIN (SELECT *, {_POS.format(t="created_at", i="lsn")} AS pos FROM ({_COUNTING_SQL}) c) t
  ON r.ticket_id = t.ticket_id AND r.pos >= t.pos
""")
def q_ticket_state_at_times(spark, d):
    """L2 at the time of every request, from the stored interval table."""
    path = run_dir(spark, "ticket_history")
    history.write_history(_log(spark, d), path)
    return history.states_at(spark, path, td.ticket_requests(spark, d), "request_id")


@register("expiry_sweep", f"""
SELECT 'DELETE' AS op, ticket_id FROM ({_TICKETS_SQL}) t WHERE expires_at < {_END_SQL}
""")
def q_expiry_sweep(spark, d):
    """L4 at the end of the log."""
    state = _with_time(tickets.replay(_log(spark, d)), spark, d, F.max("ts"))
    deletes, _ = tickets.expiry_sweep(state, F.col("_as_of"))
    return deletes


@register("tickets_after_sweep", f"""
SELECT * FROM ({_TICKETS_SQL}) t WHERE expires_at >= {_END_SQL}
""")
def q_tickets_after_sweep(spark, d):
    state = _with_time(tickets.replay(_log(spark, d)), spark, d, F.max("ts"))
    _, remaining = tickets.expiry_sweep(state, F.col("_as_of"))
    return remaining.drop("_as_of")


@register("validate", _finish_sql(_JOINED_SQL))
def q_validate(spark, d):
    return tickets.validate_log(_log(spark, d), td.ticket_requests(spark, d))


@register("validate_swept", _swept_sql("CASE WHEN status = 'valid' THEN ts END"))
def q_validate_swept(spark, d):
    return tickets.validate_log_swept(_log(spark, d), td.ticket_requests(spark, d), "valid")


@register("validate_swept_all", _swept_sql("ts"))
def q_validate_swept_all(spark, d):
    return tickets.validate_log_swept(_log(spark, d), td.ticket_requests(spark, d), "all")


_VALIDATED_AT = """strftime(ts, '%Y-%m-%d %H:%M:%S')
       || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END
       || '+00:00'"""
_VALIDATION_LOG_SQL = f"""
SELECT tn AS passenger_name, ticket_id, {_VALIDATED_AT} AS validated_at
FROM ({_JOINED_SQL}) j WHERE status = 'valid'
"""


@register("validation_log", _VALIDATION_LOG_SQL)
def q_validation_log(spark, d):
    v = tickets.validate_log(_log(spark, d), td.ticket_requests(spark, d))
    return tickets.parse_validation_lines(tickets.validation_lines(v))


@register("validation_log_file", _VALIDATION_LOG_SQL)
def q_validation_log_file(spark, d):
    """The lines appended to a log folder, then read back."""
    path = f"{run_dir(spark, 'validation_log')}/transaction_log"
    v = tickets.validate_log(_log(spark, d), td.ticket_requests(spark, d))
    append_validation_lines(v.where(F.col("status") == "valid"), path)
    return tickets.parse_validation_lines(read_text_or_empty(spark, path))


@register("ticket_lookup", f"""
SELECT q.ticket_id, CASE WHEN t.ticket_id IS NULL THEN 'not_found' ELSE 'found' END AS status,
       t.passenger_name, t.created_at, t.expires_at
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticket_id FROM events) q
LEFT JOIN ({_TICKETS_SQL}) t ON q.ticket_id = t.ticket_id
""")
def q_ticket_lookup(spark, d):
    ids = td.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("ticket_id")).distinct()
    return tickets.lookup(tickets.replay(_log(spark, d)), ids)


_ISO_SQL = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


@register("iso_times", f"""
SELECT event_id, {_ISO_SQL.format(c="ts")} AS text, ts AS back FROM events
""")
def q_iso_times(spark, d):
    """A time as ISO-8601 text with its offset, and back."""
    e = td.table(spark, d, "events").select("event_id", format_iso(F.col("ts").cast("timestamp")).alias("text"))
    return e.select("event_id", "text", parse_iso("text").cast("timestamp_ntz").alias("back"))


@register("log_cycle", f"""
WITH pay AS (SELECT sha256(length(event_id::VARCHAR) || ':' || event_id) AS ticket_id,
                    'passenger ' || user_id AS passenger_name, ts FROM events WHERE event_type = 'purchase')
SELECT ticket_id, passenger_name, {_ISO_SQL.format(c="ts")} AS created_at,
       {_ISO_SQL.format(c="ts + INTERVAL 1 DAY")} AS expires_at
FROM pay WHERE ts + INTERVAL 1 DAY >= {_END_SQL}
""")
def q_log_cycle(spark, d):
    """L1, K6, S5, L2, L4 in a circle: payments become CREATE records in the log
    folder, their fold is swept at the end of the log, the sweep's DELETE
    records go to the same folder, and the whole folder is folded again."""
    folder = f"{run_dir(spark, 'log_cycle')}/wal"
    tickets.issue_to_log(_payments(spark, d), folder, 1, ["event_id"], ttl="1 DAY")
    state = tickets.typed(tickets.replay(read_log(spark, folder, explicit_lsn=True)))
    end = td.table(spark, d, "events").agg(F.max("ts").cast("timestamp").alias("_as_of"))
    tickets.sweep_to_log(state.crossJoin(end), F.col("_as_of"), folder, 2)
    return tickets.replay(read_log(spark, folder, explicit_lsn=True))


@register("log_derived_order", f"""
SELECT ticket_id, passenger_name, op FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) AS rn FROM ({_COUNTING_SQL}) c) x
WHERE rn = 1
""")
def q_log_derived_order(spark, d):
    """S5 without lsn fields: the records' order is that of the written lines."""
    folder = f"{run_dir(spark, 'log_derived')}/wal"
    records = _log(spark, d).orderBy("lsn").select("op", "ticket_id", "passenger_name")
    records.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    last = tickets.replay(read_log(spark, folder), keep_tombstones=True)
    return last.select("ticket_id", "passenger_name", "op")


def _payments(spark, d):
    return (td.table(spark, d, "events").where(F.col("event_type") == "purchase")
            .select("event_id",
                    F.concat(F.lit("passenger "), F.col("user_id").cast("string"))
                    .alias("passenger_name"),
                    F.col("ts").alias("paid_at")))


@register("issue_tickets", """
SELECT 'CREATE' AS op, sha256(length(CAST(event_id AS VARCHAR)) || ':' || event_id) AS ticket_id,
       'passenger ' || CAST(user_id AS VARCHAR) AS passenger_name,
       ts AS created_at, ts + INTERVAL 1 HOUR AS expires_at
FROM events WHERE event_type = 'purchase'
""")
def q_issue_tickets(spark, d):
    return tickets.issue_tickets(_payments(spark, d), ["event_id"])


# --------------------------------------------------------------------------
# L3 bad-line handling over whole tables: every event becomes a log line; a
# view becomes an object with trailing text, an error an object without its
# comma, a click a blank line, the rest JSON records. Every line that isn't blank
# is either a record or a bad line.
# --------------------------------------------------------------------------
def _log_lines(spark, d):
    e = td.table(spark, d, "events")
    op = (F.when(F.col("event_type").isin(*td.CREATE_TYPES), F.lit("CREATE"))
          .when(F.col("event_type").isin(*td.DELETE_TYPES), F.lit("DELETE"))
          .otherwise(F.upper("event_type")))
    rec = F.to_json(F.struct(op.alias("op"), F.col("user_id").cast("string").alias("ticket_id")))
    value = (F.when(F.col("event_type") == "view", F.concat(rec, F.lit(" trailing")))
             .when(F.col("event_type") == "error", F.regexp_replace(rec, ",", " "))
             .when(F.col("event_type") == "click", F.lit("   "))
             .otherwise(rec))
    return e.select(value.alias("value"), F.col("event_id").alias("lsn"))


_OP_SQL = """CASE WHEN event_type IN ('signup', 'purchase') THEN 'CREATE'
            WHEN event_type = 'error' THEN 'DELETE' ELSE upper(event_type) END"""


@register("log_parse", f"""
SELECT event_id AS lsn, {_OP_SQL} AS op, CAST(user_id AS VARCHAR) AS ticket_id
FROM events WHERE event_type NOT IN ('view', 'click', 'error')
""")
def q_log_parse(spark, d):
    return parse_records(_log_lines(spark, d)).select("lsn", "op", "ticket_id")


@register("log_bad_lines", """
SELECT event_id AS lsn FROM events WHERE event_type IN ('view', 'error')
""")
def q_log_bad_lines(spark, d):
    return bad_records(_log_lines(spark, d)).select("lsn")
