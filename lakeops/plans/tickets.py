"""Ticket log: issue, replay, expiry sweep, validation, lookups.

The log is a DataFrame of records ``(lsn, op, ticket_id, passenger_name,
created_at, expires_at)``; the current tickets are the fold of the log:
the last CREATE/DELETE per ticket in lsn order decides. That fold is a
grouped ``max_by`` (a partial aggregate), so it distributes and a ticket
with a huge history costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (as_of_lit, epoch_micros, format_iso, is_expired, parse_iso, plus_interval,
                               stable_id)
from ..operators.scan import exclusive_running_max, last_before
from ..sinks.logs import validation_line

OPS = ("CREATE", "DELETE")
STATE_COLS = ["ticket_id", "passenger_name", "created_at", "expires_at"]


def issue_tickets(payments: DataFrame, key_cols: list[str], name_col: str = "passenger_name",
                  paid_at: str = "paid_at", ttl: str = "1 HOUR") -> DataFrame:
    """L1: one CREATE record per payment: id from ``key_cols``, which must
    identify the payment (stable on retry; two payments of one name at one time
    are two tickets), created = payment time, expires = created + ttl."""
    if not key_cols:
        raise ValueError("key_cols must name the columns that identify a payment")
    return payments.select(
        F.lit("CREATE").alias("op"),
        stable_id(*key_cols).alias("ticket_id"),
        F.col(name_col).alias("passenger_name"),
        F.col(paid_at).alias("created_at"),
        plus_interval(paid_at, ttl).alias("expires_at"))


def typed(log: DataFrame) -> DataFrame:
    """Parse ISO-8601 text times of a read log into timestamps."""
    out = log
    for c in ("created_at", "expires_at"):
        if dict(log.dtypes).get(c) == "string":
            out = out.withColumn(c, parse_iso(c))
    return out


def replay(log: DataFrame, keep_tombstones: bool = False) -> DataFrame:
    """L2: log -> current tickets.

    Only CREATE and DELETE count (other ops never hide an earlier CREATE);
    records without a ticket id are dropped. Per ticket the counting record
    with the highest lsn wins: CREATE after DELETE revives, DELETE of an
    unknown id leaves nothing. With ``keep_tombstones`` the winning DELETE
    rows are kept (op column), for incremental folding (L8).

    Counting records rank above the others inside the ``max_by`` and the
    winner is checked after the aggregate, instead of filtering the input:
    on a decoded log such an input filter is pushed into the scan and
    repeats the JSON parse per field. The check reads the winner's own copy
    of the id, so it is not pushed below the aggregate either."""
    counts = (F.col("op").isin(*OPS) & (F.length(F.col("ticket_id")) > 0))
    rank = F.struct(F.coalesce(counts, F.lit(False)).alias("_counts"), F.col("lsn"))
    payload = F.struct(F.col("lsn"), F.col("op"), F.col("ticket_id").alias("_tid"),
                       F.col("passenger_name"), F.col("created_at"), F.col("expires_at"))
    last = (log.groupBy("ticket_id").agg(F.max_by(payload, rank).alias("_w"))
            .where(F.col("_w.op").isin(*OPS) & (F.length(F.col("_w._tid")) > 0))
            .select("ticket_id", *[F.col(f"_w.{c}").alias(c) for c in
                                   ("lsn", "op", "passenger_name", "created_at", "expires_at")]))
    if keep_tombstones:
        return last
    return last.where(F.col("op") == "CREATE").select(*STATE_COLS)


def expiry_sweep(tickets: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """L4: expired tickets (``expires_at < as_of``, strict) become DELETE
    records; returns (delete_records, remaining_tickets)."""
    now = _now_like(tickets, as_of)
    expired = is_expired("expires_at", now)
    deletes = tickets.where(expired).select(F.lit("DELETE").alias("op"), "ticket_id")
    return deletes, tickets.where(~expired | F.col("expires_at").isNull())


def replay_as_of(log: DataFrame, as_of, at: str = "created_at") -> DataFrame:
    """L2 up to a point in time: the tickets as they were at ``as_of`` (a value
    or a column of ``log``), from the records whose ``at`` is not later. Later
    records rank below all others in the fold, so the log is read once."""
    known = F.coalesce(F.col(at) <= as_of, F.lit(False))
    return replay(log.withColumn("op", F.when(known, F.col("op"))))


def _now_like(tickets: DataFrame, as_of):
    ntz = dict(tickets.dtypes).get("expires_at") == "timestamp_ntz"
    return as_of_lit(as_of, ntz=ntz)


def _base_status(r: DataFrame) -> DataFrame:
    absent = F.col("_t_created").isNull() | (F.col("_t_created") > F.col("ts"))
    return r.withColumn(
        "status",
        F.when(absent, F.lit("not_found"))
        .when(F.col("ts") <= F.col("_t_expires"), F.lit("valid"))
        .otherwise(F.lit("expired")))


def _join_tickets(requests: DataFrame, tickets: DataFrame) -> DataFrame:
    t = tickets.select("ticket_id", F.col("passenger_name").alias("_t_name"),
                       F.col("created_at").alias("_t_created"),
                       F.col("expires_at").alias("_t_expires"))
    return requests.join(t, "ticket_id", "left")


def _finish(r: DataFrame) -> DataFrame:
    valid = F.col("status") == "valid"
    return r.select("request_id", "ticket_id", "ts", "status",
                    F.when(valid, F.col("_t_name")).alias("passenger_name"),
                    F.when(valid, F.col("_t_expires")).alias("expires_at"))


def validate(tickets: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per request (request_id, ticket_id, ts): status
    ``not_found`` (no ticket, or the request precedes its creation),
    ``expired`` (ts > expires_at) or ``valid``; name and expiry only when
    valid. A ticket without an expiry (possible only in a replica's log) is
    reported ``expired``. A left join: a hot ticket id is split by AQE's
    skew handling."""
    return _finish(_base_status(_join_tickets(requests, tickets)))


def validate_swept(tickets: DataFrame, requests: DataFrame, sweep_on: str = "valid",
                   segments: int | None = None) -> DataFrame:
    """Validation where each request triggers an expiry sweep after it.

    ``sweep_on='valid'``: only valid requests sweep (what runs when failed
    requests raise before their background task); ``'all'``: every request.
    A request whose ticket expired is ``not_found`` when some triggering
    request strictly before it (by ts, then request_id) came after the
    expiry, since that sweep removed the ticket; otherwise ``expired``.
    Validity itself never depends on sweeps (only expired tickets go).

    The latest earlier trigger time is a global prefix max, computed by a
    balanced scan in segments (``operators.scan``), not a one-task window.
    """
    return _swept(_base_status(_join_tickets(requests, tickets)), sweep_on, segments)


def _swept(r: DataFrame, sweep_on: str, segments: int | None) -> DataFrame:
    if sweep_on not in ("valid", "all"):
        raise ValueError("sweep_on must be 'valid' or 'all'")
    types = dict(r.dtypes)
    micros = epoch_micros("ts", types["ts"] == "timestamp_ntz")
    trig = micros if sweep_on == "all" else F.when(F.col("status") == "valid", micros)
    r = r.withColumn("_trig", trig)
    r = exclusive_running_max(r, ["ts", "request_id"], "_trig", "_prev", segments)
    expires = epoch_micros("_t_expires", types["_t_expires"] == "timestamp_ntz")
    swept = (F.col("status") == "expired") & (F.col("_prev") > expires)
    r = r.withColumn("status", F.when(swept, F.lit("not_found")).otherwise(F.col("status")))
    return _finish(r)


def state_at_requests(log: DataFrame, requests: DataFrame, at: str = "created_at",
                      segments: int | None = None) -> DataFrame:
    """Each request (request_id, ticket_id, ts) with the ticket as it was at
    that moment: ``_t`` is the last CREATE or DELETE record of the ticket ahead of
    the request by (time, id), where a record's time is its ``at`` and its id
    the lsn. ``lsn`` and ``request_id`` are of one type; equal (time, id) puts the
    record first. One scan over records and requests in (ticket, time, id) order
    (``operators.scan.last_before``), in segments that split a hot ticket."""
    record = F.struct("op", "passenger_name", "created_at", "expires_at")
    none = F.lit(None).cast("timestamp_ntz" if dict(requests.dtypes)["ts"] == "timestamp_ntz" else "timestamp")
    records = (log.where(F.col("op").isin(*OPS) & (F.length("ticket_id") > 0))
               .select("ticket_id", F.col(at).alias("_at"), F.col("lsn").alias("_id"), F.lit(0).alias("_kind"),
                       none.alias("ts"), record.alias("_record")))
    asked = requests.select("ticket_id", F.col("ts").alias("_at"), F.col("request_id").alias("_id"),
                            F.lit(1).alias("_kind"), "ts")
    rows = records.unionByName(asked, allowMissingColumns=True)
    out = last_before(rows, "ticket_id", ["_at", "_id", "_kind"], F.col("_record"), "_t", segments)
    return out.where("_kind = 1").select(F.col("_id").alias("request_id"), "ticket_id", "ts", "_t")


def _status_then(log: DataFrame, requests: DataFrame, **kw) -> DataFrame:
    r = state_at_requests(log, requests, **kw)
    there = F.coalesce(F.col("_t.op") == "CREATE", F.lit(False))
    status = (F.when(~there, "not_found").when(F.col("ts") <= F.col("_t.expires_at"), "valid")
              .otherwise("expired"))
    return r.select("request_id", "ticket_id", "ts", status.alias("status"),
                    F.col("_t.passenger_name").alias("_t_name"), F.col("_t.expires_at").alias("_t_expires"))


def validate_log(log: DataFrame, requests: DataFrame, **kw) -> DataFrame:
    """L5 against the log: as ``validate``, with every request judged by the
    state at its own time."""
    return _finish(_status_then(log, requests, **kw))


def validate_log_swept(log: DataFrame, requests: DataFrame, sweep_on: str = "valid",
                       segments: int | None = None, **kw) -> DataFrame:
    """L6 against the log: as ``validate_swept``, with every request judged by
    the state at its own time. The sweeps' DELETEs are those of the requests
    given; they touch expired tickets only, so they turn ``expired`` into
    ``not_found`` and nothing else."""
    return _swept(_status_then(log, requests, segments=segments, **kw), sweep_on, segments)


def validation_lines(validated: DataFrame) -> DataFrame:
    """L7 (write side): the log line of every valid request."""
    return validated.where(F.col("status") == "valid").select(
        validation_line("passenger_name", "ticket_id", "ts").alias("value"))


LINE_PATTERN = r"^(.*) \| ticket (\S+) validated at (.*)$"


def parse_validation_lines(lines: DataFrame) -> DataFrame:
    """L7 (read side): split ``name | ticket ID validated at TS`` lines."""
    v = F.col("value")
    return (lines.where(v.rlike(LINE_PATTERN))
            .select(F.regexp_extract(v, LINE_PATTERN, 1).alias("passenger_name"),
                    F.regexp_extract(v, LINE_PATTERN, 2).alias("ticket_id"),
                    F.regexp_extract(v, LINE_PATTERN, 3).alias("validated_at")))


def lookup(tickets: DataFrame, ticket_ids: DataFrame) -> DataFrame:
    """Per asked id the ticket fields, or status ``not_found``."""
    t = tickets.select(*STATE_COLS).withColumn("_hit", F.lit(True))
    return (ticket_ids.select("ticket_id").join(t, "ticket_id", "left")
            .select("ticket_id",
                    F.when(F.col("_hit"), F.lit("found")).otherwise(F.lit("not_found"))
                    .alias("status"),
                    "passenger_name", "created_at", "expires_at"))


def as_log_records(records: DataFrame) -> DataFrame:
    """Log form of CREATE/DELETE records: times as ISO-8601 text with offset
    (as the log stores them), missing fields as NULL."""
    cols = dict(records.dtypes)

    def text(c):
        if c not in cols:
            return F.lit(None).cast("string").alias(c)
        if cols[c] in ("timestamp", "timestamp_ntz"):
            ts = F.col(c) if cols[c] == "timestamp" else F.col(c).cast("timestamp")
            return format_iso(ts).alias(c)
        return F.col(c).cast("string").alias(c)
    return records.select(*[text(c) for c in ("op", "ticket_id", "passenger_name",
                                              "created_at", "expires_at")])


def issue_to_log(payments: DataFrame, log_dir: str, batch_id: int, key_cols: list[str], **kw) -> DataFrame:
    """L1 with K6: append the CREATE records to the log first (one file set
    per batch, explicit lsn), then return them; the state is their fold."""
    from ..sinks.logs import append_log
    recs = issue_tickets(payments, key_cols, **kw)
    append_log(as_log_records(recs).orderBy("created_at", "ticket_id"), log_dir, batch_id)
    return recs


def sweep_to_log(tickets: DataFrame, as_of, log_dir: str, batch_id: int) -> DataFrame:
    """L4 with K6: append a DELETE record for every expired ticket, return
    the remaining tickets."""
    from ..sinks.logs import append_log
    deletes, remaining = expiry_sweep(tickets, as_of)
    append_log(as_log_records(deletes).orderBy("ticket_id"), log_dir, batch_id)
    return remaining
