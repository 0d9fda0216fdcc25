"""Streams with keyed state in event time: live validation (L5), expiry by
timers (L4) and first record per order id (W1, option B).

Rows of a key are taken in the order of (event time, id, kind), whatever
micro-batches they came in: a row waits in the key's state until the watermark
has passed its time, because until then an earlier one may still come. What the
stream returns is therefore the same for every split of the input into files and
micro-batches and after any restart from the checkpoint, as long as no row is later
than the watermark's delay. Later rows are dropped by the stateful operator and
counted in the query's progress (``numRowsDroppedByWatermark``); they change
nothing that was returned.

The watermark moves with the rows. A source that falls silent should send ticks (rows
of kind TICK), which carry a time and nothing else.

State lives in RocksDB: per key one settled row and the rows that wait, so its
size follows the keys and the delay, never the length of the stream. A visit to a
state from Python costs milliseconds whatever it holds, so keys share ``SLOTS``
groups (by hash): rows of a slot wait together, settle together when its one timer, at the
earliest thing that waits, fires, and their settled rows are stored by cell, a cell
being read and written only if one of its keys moves. A task holds the waiting rows of
one slot at a time; streams with more keys or a longer delay take more slots (fixed
for the life of a checkpoint). With ``slots=0`` each key has a state and a timer of its own.
A hot key is in one slot: its rows of a batch pass through one task.

Times are whole microseconds in state, so their precision is that of the input
and no time zone applies."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..plans.orders import decode
from ..plans.tickets import OPS
from ..session import shared_path

RECORD, REQUEST, NULL_REQUEST, TICK = 0, 1, 2, 9
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SLOTS, CELLS = 1024, 64
_WAITING = "at long, id long, kind int, op string, passenger_name string, expires_at long"


def micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone (a
    time without zone counts as UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _longs(c: pd.Series) -> list:
    return [None if gone else int(x) for x, gone in zip(c, c.isna())]


def _time(at_micros: pd.Series) -> pd.Series:
    return pd.to_datetime(at_micros.astype("Int64"), unit="us")


class _InOrder(StatefulProcessor):
    """Rows of a key settle in order once the watermark has passed them."""

    waiting_schema: str
    settled_schema: str

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.settled = handle.getValueState("settled", self.settled_schema)

    def taken(self, pdf):
        return self.kept(self.read(pdf))

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for pdf in rows:
            new += self.taken(pdf)
        yield from self._settle(key, timerValues.getCurrentWatermarkInMs(), new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle(key, timerValues.getCurrentWatermarkInMs(), [])

    def _settle(self, key, watermark_ms, new):
        passed = watermark_ms * 1000
        held = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        every = sorted(held + new, key=lambda w: w[:3])
        ripe = [w for w in every if w[0] <= passed]
        rest = every[len(ripe):]
        before = tuple(self.settled.get()) if self.settled.exists() else None
        out, after = self.advance(key, before, ripe, passed)
        if after != before:
            self.settled.clear() if after is None else self.settled.update(after)
        if new or ripe:
            self.waiting.put(rest) if rest else self.waiting.clear()
        self._wake_at(self.next_time(after, rest), passed)
        if out:
            yield pd.DataFrame(out, columns=list(self.columns)).astype(self.columns)

    def _wake_at(self, at, passed):
        _wake_at(self.handle, list(self.handle.listTimers()), at, passed)

    def close(self) -> None:
        pass


def _wake_at(handle, timers, at, passed):
    """One timer, at the first millisecond by which ``at`` has passed."""
    wanted = None if at is None else max(-(-at // 1000), passed // 1000 + 1)
    for t in timers:
        if t != wanted:
            handle.deleteTimer(t)
    if wanted is not None and wanted not in timers:
        handle.registerTimer(wanted)


class _Slot(StatefulProcessor):
    """The keys of a slot, each by the rules of ``own`` (an ``_InOrder``)."""

    def __init__(self, own: _InOrder, key: str):
        self.own, self.key = own, key

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")    # [(key, row)], a batch's rows in one
        self.settled = handle.getMapState("settled", "cell int", "rows binary")    # {key: settled row}
        self.due = handle.getMapState("due", "cell int", "at long")     # when a settled row of a cell next moves

    def handleInputRows(self, key, rows, timerValues):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        by_key = {}
        for pdf in rows:
            for k, row in zip(pdf[self.key], self.own.read(pdf)):
                by_key.setdefault(k, []).append(row)
        new = [(k, row) for k, read in by_key.items() for row in self.own.kept(read)]
        if not new:
            return
        timers = list(self.handle.listTimers())
        first = min([row[0] for _, row in new] + [t * 1000 for t in timers])
        if first <= passed:         # a timer that is due would be put off by its renewal
            yield from self._settle(passed, new)
        else:
            self.waiting.appendValue((pickle.dumps(new),))
            _wake_at(self.handle, timers, first, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle(timerValues.getCurrentWatermarkInMs() * 1000, [])

    def _settle(self, passed, new):
        ripe, rest, held = {}, [], False
        if self.waiting.exists():
            held = True
            new = [w for (rows,) in self.waiting.get() for w in pickle.loads(rows)] + new
        for w in new:
            if w[1][0] <= passed:
                ripe.setdefault(zlib.crc32(w[0].encode()) % CELLS, {}).setdefault(w[0], []).append(w[1])
            else:
                rest.append(w)
        if rest and (ripe or not held):
            self.waiting.put([(pickle.dumps(rest),)])
        elif held and not rest:
            self.waiting.clear()
        due = {c: at for (c,), (at,) in self.due.iterator()}
        out = []
        for cell in sorted(ripe.keys() | {c for c, at in due.items() if at <= passed}):
            out += self._settle_cell(cell, ripe.get(cell, {}), due, passed)
        _wake_at(self.handle, list(self.handle.listTimers()),
                 min([row[0] for _, row in rest] + list(due.values()), default=None), passed)
        if out:
            yield pd.DataFrame(out, columns=list(self.own.columns)).astype(self.own.columns)

    def _settle_cell(self, cell, ripe, due, passed):
        stored = self.settled.getValue((cell,))
        settled = {} if stored is None else pickle.loads(stored[0])
        late = due.get(cell)
        out, moved = [], False
        for k in list(settled.keys() | ripe.keys()) if late is not None and late <= passed else list(ripe):
            before = settled.get(k)
            found, after = self.own.advance((k,), before, sorted(ripe.get(k, ()), key=lambda w: w[:3]), passed)
            out += found
            if after != before:
                moved = True
                if after is None:
                    del settled[k]
                else:
                    settled[k] = after
        if moved and settled:
            self.settled.updateValue((cell,), (pickle.dumps(settled),))
        elif moved:
            self.settled.removeKey((cell,))
        at = min((t for t in (self.own.next_time(s, []) for s in settled.values()) if t is not None), default=None)
        if at is None:
            if due.pop(cell, None) is not None:
                self.due.removeKey((cell,))
        elif at != late:
            self.due.updateValue((cell,), (at,))
            due[cell] = at
        return out

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- live validation

class LiveValidation(_InOrder):
    """Requests judged by the ticket's last record ahead of them."""

    waiting_schema = _WAITING
    settled_schema = "op string, passenger_name string, expires_at long"
    columns = {"request_id": "int64", "ticket_id": "object", "at": "int64", "status": "object",
               "passenger_name": "object", "expires_at": "Int64"}
    result = "request_id long, ticket_id string, at long, status string, passenger_name string, expires_at long"

    def read(self, pdf):
        return [(int(a), int(i), int(k), o, n, e) for a, i, k, o, n, e in zip(
            pdf["at_us"], pdf["id"], pdf["kind"], pdf["op"], pdf["passenger_name"], _longs(pdf["expires_at"]))]

    def kept(self, rows):
        return [r for r in rows if r[2] != TICK]

    def advance(self, key, last, ripe, passed):
        out = []
        for at, who, kind, op, name, expires in ripe:
            if kind == RECORD:
                last = (op, name, expires)
                continue
            there = last is not None and last[0] == "CREATE"
            valid = there and last[2] is not None and at <= last[2]
            status = "valid" if valid else "expired" if there else "not_found"
            out.append((who, None if kind == NULL_REQUEST else key[0], at, status,
                        last[1] if valid else None, last[2] if valid else None))
        return out, last

    def next_time(self, last, rest):
        """Records alone may wait for the key's next rows; requests may not."""
        return min((w[0] for w in rest if w[2] != RECORD), default=None)


def record_rows(log: DataFrame, at: str = "created_at") -> DataFrame:
    """Log records (lsn, op, ticket_id, passenger_name, created_at, expires_at)
    as stream rows. Only CREATE and DELETE with a ticket id count, and
    records without a time can't be placed."""
    return (log.where(F.col("op").isin(*OPS) & (F.length("ticket_id") > 0) & F.col(at).isNotNull())
            .select(F.col("ticket_id").alias("ticket"), F.col(at).cast("timestamp").alias("at"),
                    micros(at).alias("at_us"), F.col("lsn").cast("long").alias("id"), F.lit(RECORD).alias("kind"),
                    "op", "passenger_name", micros("expires_at").alias("expires_at")))


def request_rows(requests: DataFrame) -> DataFrame:
    """Requests (request_id, ticket_id, ts) as stream rows; those without a
    time can't be placed."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    return (requests.where(F.col("ts").isNotNull())
            .select(F.coalesce("ticket_id", F.lit("")).alias("ticket"), F.col("ts").cast("timestamp").alias("at"),
                    micros("ts").alias("at_us"), F.col("request_id").cast("long").alias("id"),
                    F.when(F.col("ticket_id").isNull(), NULL_REQUEST).otherwise(REQUEST).alias("kind"),
                    text.alias("op"), text.alias("passenger_name"), number.alias("expires_at")))


ROWS = ("ticket string, at timestamp, at_us long, id long, kind int, op string, passenger_name string, "
        "expires_at long")


def keyed(source: DataFrame, key: str, processor: Callable[[], _InOrder], delay: str, slots: int = SLOTS) -> DataFrame:
    """``source`` (with the event time ``at``) through a processor, by key, the
    keys sharing ``slots`` groups (0: none)."""
    p = processor()
    rows = source.withWatermark("at", delay)
    if not slots:
        return rows.groupBy(key).transformWithStateInPandas(p, p.result, "Append", "EventTime")
    slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")
    return (rows.withColumn("slot", slot).groupBy("slot")
            .transformWithStateInPandas(_Slot(p, key), p.result, "Append", "EventTime"))


def live_validation(source: DataFrame, delay: str = "10 minutes", slots: int = SLOTS) -> DataFrame:
    """L5 as a stream of ``ROWS`` (records and requests): one row for each
    request, when its time has passed. The status is that of
    ``tickets.validate_log`` over the same rows."""
    v = keyed(source, "ticket", LiveValidation, delay, slots)
    ntz = "timestamp_ntz"
    return v.select("request_id", "ticket_id", F.timestamp_micros("at").cast(ntz).alias("ts"), "status",
                    "passenger_name", F.timestamp_micros("expires_at").cast(ntz).alias("expires_at"))


# ---------------------------------------------------------------- expiry (L4)

class Expiry(_InOrder):
    """A DELETE for each ticket whose expiry passes while it is current."""

    waiting_schema = _WAITING
    settled_schema = "op string, at long, expires_at long"
    columns = {"op": "object", "ticket_id": "object", "expired_at": "int64"}
    result = "op string, ticket_id string, expired_at long"
    keep_us = 0

    read, kept = LiveValidation.read, LiveValidation.kept

    def advance(self, key, last, ripe, passed):
        out = []

        def expire(by):
            """The current ticket ends if its expiry lies before ``by``."""
            nonlocal last
            if last is not None and last[0] == "CREATE" and last[2] is not None and last[2] < by:
                out.append(("DELETE", key[0], last[2]))
                last = ("DELETE", last[2], None)

        for at, _, _, op, _, expires in ripe:
            expire(at)
            last = (op, at, expires)
        expire(passed)
        if last is not None and last[0] == "DELETE" and last[1] + self.keep_us <= passed:
            last = None         # no record that could come is older than this
        return out, last

    def next_time(self, last, rest):
        times = [w[0] for w in rest]
        if last is not None and last[0] == "CREATE" and last[2] is not None:
            times.append(last[2] + 1)           # expired only after the instant itself
        if last is not None and last[0] == "DELETE":
            times.append(last[1] + self.keep_us)
        return min(times, default=None)


def expiries(source: DataFrame, delay: str = "10 minutes", keep_tombstones_us: int = 0,
             slots: int = SLOTS) -> DataFrame:
    """L4 as a stream of ``ROWS``: (op, ticket_id, expired_at), one DELETE
    for each CREATE that is still the ticket's last record when its expiry
    passes (``expires_at`` strictly before the watermark or the next record).
    A deleted ticket's state is dropped ``keep_tombstones_us`` after its end; older
    records of it can't come any more, they would be late."""
    class Own(Expiry):
        keep_us = int(keep_tombstones_us)

    e = keyed(source, "ticket", Own, delay, slots)
    return e.select("op", "ticket_id", F.timestamp_micros("expired_at").cast("timestamp_ntz").alias("expired_at"))


# ---------------------------------------------------------------- first record per order id

class FirstWins(_InOrder):
    """The first row of a key, once; the key is remembered for good or until
    ``forget_us`` after that row."""

    waiting_schema = "at long, id long, kind int, username string, item_name string, quantity int"
    settled_schema = "at long"
    columns = {"order_uuid": "object", "username": "object", "item_name": "object", "quantity": "Int64", "at": "int64"}
    result = "order_uuid string, username string, item_name string, quantity int, at long"
    forget_us: int | None = None

    def read(self, pdf):
        return [(int(a), int(i), RECORD, u, n, q) for a, i, u, n, q in zip(
            pdf["at_us"], pdf["id"], pdf["username"], pdf["item_name"], _longs(pdf["quantity"]))]

    def kept(self, rows):
        return rows if self.forget_us is not None or not rows else [min(rows, key=lambda r: r[:2])]

    def advance(self, key, last, ripe, passed):
        out = []
        for at, _, _, user, item, quantity in ripe:
            if last is not None and self.forget_us is not None and last[0] + self.forget_us < at:
                last = None
            if last is None:
                out.append((key[0], user, item, quantity, at))
                last = (at,)
        if last is not None and self.forget_us is not None and last[0] + self.forget_us < passed:
            last = None
        return out, last

    def next_time(self, last, rest):
        times = [w[0] for w in rest]
        if last is not None and self.forget_us is not None:
            times.append(last[0] + self.forget_us + 1)
        return min(times, default=None)


def first_wins(source: DataFrame, delay: str = "10 minutes", forget_us: int | None = None,
               slots: int = SLOTS) -> DataFrame:
    """W1 option B over messages (value, at, id): the first accepted message
    per order id by (at, id), with no target table to probe. ``forget_us`` bounds
    the state: an id seen again later than that is a new order."""
    class Own(FirstWins):
        pass

    Own.forget_us = forget_us
    good = (decode(source, ["at", "id"]).where(F.col("reject_reason").isNull() & F.col("order_uuid").isNotNull())
            .select("order_uuid", "at", micros("at").alias("at_us"), "id", "username", "item_name", "quantity"))
    return keyed(good, "order_uuid", Own, delay, slots).select(
        "order_uuid", "username", "item_name", "quantity", F.timestamp_micros("at").cast("timestamp_ntz").alias("at"))


# ---------------------------------------------------------------- running

def start(stream: DataFrame, out: str, checkpoint: str | None = None, trigger: dict | None = None,
          query_name: str = "keyed") -> StreamingQuery:
    """Append the stream's rows to the Parquet folder ``out`` (each once: the
    file sink and the state commit by micro-batch). The RocksDB state store is
    set for this query where the session names no store of its own."""
    spark = stream.sparkSession
    own = spark.conf.get(PROVIDER, None)
    if own != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (stream.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", checkpoint or shared_path(spark, "streams", query_name))
                .trigger(**(trigger or {"processingTime": "2 seconds"})).start())
    finally:
        if own is None:
            spark.conf.unset(PROVIDER)
        elif own != ROCKSDB:
            spark.conf.set(PROVIDER, own)


def results(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)
