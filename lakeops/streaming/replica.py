"""Replica sync (L8, L9): keep a ticket snapshot in step with the log.

The log is a directory of finished JSON-lines files written by
``sinks.logs.append_log`` (explicit lsn). A file stream turns each new file
into a micro-batch; ``foreachBatch`` folds the new records into the previous
state and publishes a new snapshot (K5). The state is kept in buckets of the
ticket id's hash, and a batch reads and rewrites only the buckets it touches
(``sinks.bucketed``): cost follows the new records and their buckets, not the
whole state or log.

The stored state keeps DELETE tombstones (the winning record per ticket,
whatever its op), so a late or replayed file cannot revive a deleted ticket
with an older CREATE. Readers see only CREATE rows (``current_tickets``).
Each batch writes version ``latest published + 1``. Folding is idempotent
(the last record per ticket by lsn), so a retried batch writes a version
with the same content; an attempt that died before it was published leaves a
folder that the next attempt overwrites. One writer per base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.joins import MAX_PROBE_BYTES, key_bytes
from ..plans import tickets
from ..session import shared_path
from ..sinks import bucketed, snapshot
from ..sources import tail
from ..sources.jsonlog import parse_records, read_log

BUCKETS = 64                # of a new state; a stored one keeps its number

STATE_SCHEMA = ("ticket_id string, lsn struct<batch:bigint,seq:bigint>, op string, "
                "passenger_name string, created_at string, expires_at string")


def read_state(spark: SparkSession, base: str) -> DataFrame:
    _, _, entries = bucketed.current(spark, base, BUCKETS)
    return bucketed.read(spark, base, STATE_SCHEMA, entries)


def current_tickets(spark: SparkSession, base: str) -> DataFrame:
    """All current tickets of the replica (ISO text times, as logged)."""
    st = read_state(spark, base)
    return st.where(F.col("op") == "CREATE").select(*tickets.STATE_COLS)


def lookup(spark: SparkSession, base: str, ticket_ids: DataFrame) -> DataFrame:
    """The ticket's fields or status not_found."""
    return tickets.lookup(current_tickets(spark, base), ticket_ids)


COLS = ["ticket_id", "lsn", "op", "passenger_name", "created_at", "expires_at"]


def fold(state: DataFrame, records: DataFrame,
         max_probe_bytes: int = MAX_PROBE_BYTES) -> DataFrame:
    """New state = last record per ticket over (old state, new records).

    When the ids of the batch (persisted by the caller) take at most
    ``max_probe_bytes``, they are broadcast: state rows of other tickets pass through an
    anti join untouched (no shuffle of the state), and only the touched
    tickets' rows are re-folded with the new records. Otherwise the whole
    union is folded."""
    state, records = state.select(*COLS), records.select(*COLS)
    ids = records.select("ticket_id").distinct()
    if key_bytes(records, ["ticket_id"]) <= max_probe_bytes:
        probe = F.broadcast(ids)
        untouched = state.join(probe, "ticket_id", "left_anti")
        touched = state.join(probe, "ticket_id", "left_semi")
        merged = tickets.replay(touched.unionByName(records), keep_tombstones=True)
        return untouched.unionByName(merged.select(*COLS))
    return tickets.replay(state.unionByName(records), keep_tombstones=True).select(*COLS)


def _sync_batch(batch: DataFrame, epoch_id: int, base: str) -> None:
    spark = batch.sparkSession
    # parsed once: the records feed the buckets, the id bound and the fold
    records = (parse_records(batch, schemas.LOG_RECORD, explicit_lsn=True)
               .where(F.length("ticket_id") > 0).persist())
    try:
        _fold_into(spark, base, records)
    finally:
        records.unpersist()


def _fold_into(spark: SparkSession, base: str, records: DataFrame) -> None:
    """Fold persisted records into the buckets they touch."""
    version, buckets, entries = bucketed.current(spark, base, BUCKETS)
    touched = [r.b for r in records.select(bucketed.bucket_of("ticket_id", buckets).alias("b"))
               .distinct().collect()]                               # at most `buckets` rows
    if touched:
        prev = bucketed.read(spark, base, STATE_SCHEMA, entries, set(touched))
        bucketed.write(fold(prev, records), base, "ticket_id", version + 1, buckets, entries, touched)


def start_sync(spark: SparkSession, log_dir: str, base: str, checkpoint: str | None = None,
               trigger: dict | None = None, query_name: str = "replica_sync") -> StreamingQuery:
    """``trigger`` defaults to every 2 seconds; pass ``{"availableNow": True}``
    for a one-off catch-up (L9 in stream form)."""
    ckpt = checkpoint or shared_path(spark, "streams", query_name)
    return (spark.readStream.format("text").load(log_dir).writeStream
            .foreachBatch(lambda df, eid: _sync_batch(df, eid, base))
            .option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "2 seconds"}))
            .queryName(query_name).start())


def sync_now(spark: SparkSession, log_path: str, base: str, explicit_lsn: bool = True) -> int:
    """L9 / start-up sync in batch form: replay the whole log, write a new
    snapshot (empty when the log is missing) and return the ticket count.

    ``explicit_lsn=False`` reads a log written elsewhere without an lsn
    field (plain JSON lines, e.g. one growing file): line order comes from
    file, split and row position. Such a snapshot is rebuilt by each call,
    so it is not folded into by the stream."""
    log = read_log(spark, log_path, explicit_lsn=explicit_lsn)
    state = tickets.replay(log.select(*COLS), keep_tombstones=True).select(*COLS)
    version, buckets, _ = bucketed.current(spark, base, BUCKETS)
    bucketed.write(state, base, "ticket_id", version + 1, buckets, {}, list(range(buckets)))
    return current_tickets(spark, base).count()


def log_signature(spark: SparkSession, log_path: str) -> tuple[int, int] | None:
    """(modification time, length) of a log path, or None when absent."""
    fs, p, _ = snapshot._fs(spark, log_path)
    if not fs.exists(p):
        return None
    st = fs.getContentSummary(p)
    return int(fs.getFileStatus(p).getModificationTime()), int(st.getLength())


def sync_if_changed(spark: SparkSession, log_path: str, base: str, last_seen=None,
                    explicit_lsn: bool = False):
    """For a single growing log file (which a file stream reads only once):
    replay it when its (mtime, length) changed since ``last_seen``; a log
    that disappeared gives an empty snapshot. Returns (count or None when
    unchanged, signature to pass next time). Call it from any scheduler."""
    sig = log_signature(spark, log_path)
    if sig == last_seen and last_seen is not None:
        return None, sig
    return sync_now(spark, log_path, base, explicit_lsn=explicit_lsn), sig


def follow(spark: SparkSession, log_file: str, base: str, checkpoint: str | None = None) -> int | None:
    """L8 for one growing log file: read what was appended since the last
    call, fold it into the snapshot's buckets, move the position on. Returns the number of
    new lines, None if nothing changed. Call it from any scheduler.

    A file that was replaced, cut back or deleted begins a new generation: the
    snapshot is rebuilt from what the file now holds, in one version. Should a call die
    between the snapshot and the position, the next one folds the same lines with the
    same numbers again, which changes nothing."""
    ckpt = checkpoint or f"{base.rstrip('/')}/_tail"
    found = tail.poll(spark, log_file, ckpt)
    if not found.changed:
        return None
    records = tail.records_of(spark, found).where(F.length("ticket_id") > 0).persist()
    try:
        if found.fresh:
            version, buckets, _ = bucketed.current(spark, base, BUCKETS)
            state = tickets.replay(records.select(*COLS), keep_tombstones=True).select(*COLS)
            bucketed.write(state, base, "ticket_id", version + 1, buckets, {}, list(range(buckets)))
        else:
            _fold_into(spark, base, records)
    finally:
        records.unpersist()
    tail.commit(spark, ckpt, found.after)
    tail.drop_segments(spark, ckpt, found.after)
    first = 0 if found.fresh else found.before.lines
    return found.after.lines - first
