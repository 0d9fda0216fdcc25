"""Keyed streams: the processors against row-by-row models for random splits
into micro-batches, and the streams themselves with restarts and late rows."""

import datetime as dt
import random

import pandas as pd
import pytest

from lakeops.plans import tickets
from lakeops.streaming import keyed

from .conftest import rows as listed

MS = 1000


class Held:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    put = update

    def clear(self):
        self.value = None


class Handle:
    """One key's state, as the state store keeps it."""

    def __init__(self):
        self.timers = set()

    def getListState(self, *a):
        return Held()

    getValueState = getListState

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def listTimers(self):
        return iter(sorted(self.timers))


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def drive(make, rows, delay_ms, rng, columns):
    """The rows through one processor per key, in random micro-batches whose
    disorder stays within the delay; the last watermark passes everything."""
    keys = {}
    rows = sorted(rows, key=lambda r: r["at_us"] + rng.randrange(delay_ms * MS))
    out, seen, watermark = [], 0, 0

    def fire(mark):
        for k, (p, h) in keys.items():
            for t in sorted(t for t in h.timers if t <= mark):
                if t in h.timers:
                    h.deleteTimer(t)
                    out.extend(x for f in p.handleExpiredTimer((k,), Now(mark), None) for x in f.itertuples(index=False))

    while rows:
        n = rng.randint(1, 7)
        batch, rows = rows[:n], rows[n:]
        assert all(r["at_us"] > watermark * MS for r in batch)
        for k in sorted({r["ticket"] for r in batch}):
            if k not in keys:
                p, h = make(), Handle()
                p.init(h)
                keys[k] = (p, h)
            pdf = pd.DataFrame([r for r in batch if r["ticket"] == k], columns=columns)
            cut = rng.randrange(len(pdf) + 1)
            parts = [f for f in (pdf[:cut], pdf[cut:]) if len(f)]
            for f in keys[k][0].handleInputRows((k,), iter(parts), Now(watermark)):
                out.extend(f.itertuples(index=False))
        seen = max(seen, *(r["at_us"] for r in batch))
        fire(watermark)
        if rng.random() < 0.6:
            watermark = max(watermark, seen // MS - delay_ms - 1)
            fire(watermark)
    fire(10 ** 12)
    fire(10 ** 12 + 1)
    return out, keys


COLUMNS = ["ticket", "at_us", "id", "kind", "op", "passenger_name", "expires_at"]


def ticket_rows(rng, n):
    out = []
    for i in range(n):
        at = rng.randrange(1, 4000) * rng.choice([1, 500, 1000]) + 10 ** 6
        if rng.random() < 0.5:
            op = rng.choice(["CREATE", "CREATE", "DELETE"])
            end = rng.choice([None, at, at + rng.randrange(600_000), at + 1])
            out.append(dict(zip(COLUMNS, (rng.choice("ab"), at, i, 0, op, f"n{i}", end if op == "CREATE" else None))))
        else:
            out.append(dict(zip(COLUMNS, (rng.choice("ab"), at, i, rng.choice([1, 1, 2]), None, None, None))))
    return out


def model_validation(rows):
    out, last = [], {}
    for r in sorted(rows, key=lambda r: (r["at_us"], r["id"], r["kind"])):
        if r["kind"] == 0:
            last[r["ticket"]] = r
            continue
        t = last.get(r["ticket"])
        there = t is not None and t["op"] == "CREATE"
        ok = there and t["expires_at"] is not None and r["at_us"] <= t["expires_at"]
        out.append((r["id"], None if r["kind"] == 2 else r["ticket"], r["at_us"],
                    "valid" if ok else "expired" if there else "not_found",
                    t["passenger_name"] if ok else None, t["expires_at"] if ok else None))
    return out


def model_expiry(rows):
    out, last = [], {}
    for r in sorted((r for r in rows if r["kind"] == 0), key=lambda r: (r["at_us"], r["id"])):
        t = last.get(r["ticket"])
        if t and t["op"] == "CREATE" and t["expires_at"] is not None and t["expires_at"] < r["at_us"]:
            out.append(("DELETE", r["ticket"], t["expires_at"]))
        last[r["ticket"]] = r
    return out + [("DELETE", k, t["expires_at"]) for k, t in last.items()
                  if t["op"] == "CREATE" and t["expires_at"] is not None]


def plain(found):
    return sorted((tuple(None if pd.isna(v) else v for v in t) for t in found), key=repr)


@pytest.mark.parametrize("seed", range(12))
def test_any_split_into_batches_gives_the_same(seed):
    rng = random.Random(seed)
    rows = ticket_rows(rng, 60)
    out, _ = drive(keyed.LiveValidation, rows, 300, rng, COLUMNS)
    assert plain(out) == plain(model_validation(rows))
    records = [r for r in rows if r["kind"] == 0]
    out, keys = drive(keyed.Expiry, records, 300, rng, COLUMNS)
    assert plain(out) == plain(model_expiry(rows))
    for p, h in keys.values():          # nothing is left but tickets that never expire
        assert not h.timers and p.waiting.value is None
        assert p.settled.value is None or p.settled.value[2] is None and p.settled.value[0] == "CREATE"


@pytest.mark.parametrize("forget", [None, 250_000])
def test_first_record_of_a_key(forget):
    class Own(keyed.FirstWins):
        forget_us = forget

    columns = ["ticket", "at_us", "id", "username", "item_name", "quantity"]
    for seed in range(10):
        rng = random.Random(seed)
        rows = [dict(zip(columns, (rng.choice("abc"), rng.randrange(1, 900) * 1000 + 10 ** 6, i, f"u{i}", "x",
                                   rng.choice([None, i])))) for i in range(50)]
        out, keys = drive(Own, rows, 200, rng, columns)
        want, last = [], {}
        for r in sorted(rows, key=lambda r: (r["at_us"], r["id"])):
            k = r["ticket"]
            if k not in last or forget is not None and last[k] + forget < r["at_us"]:
                want.append((k, r["username"], "x", r["quantity"], r["at_us"]))
                last[k] = r["at_us"]
        assert plain(out) == plain(want)
        if forget is not None:
            assert all(p.settled.value is None for p, _ in keys.values())


# ---------------------------------------------------------------- the streams

def day(h, m=0, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


def write(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp, make, schema, delay, files=1):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(tmp + "/in")
    q = keyed.start(make(source, delay), tmp + "/out", tmp + "/ck", {"availableNow": True})
    q.awaitTermination(180)
    assert q.exception() is None
    dropped = sum(int(o["numRowsDroppedByWatermark"]) for p in q.recentProgress for o in p["stateOperators"])
    return dropped


def test_live_validation_equals_the_batch_form(spark, tmp):
    """Restarted between arrivals, one file per micro-batch, with a row
    that is too late and requests without a ticket id."""
    rng = random.Random(3)
    log = [(i, rng.choice(["CREATE", "CREATE", "DELETE", "VIEW"]), rng.choice(["t1", "t2", "hot", "hot", "", None]),
            f"n{i}", day(rng.randrange(4), rng.randrange(60)), None) for i in range(60)]
    log = [(*r[:5], r[4] + dt.timedelta(minutes=rng.randrange(90)) if r[0] % 7 else None) for r in log]
    asked = [(100 + i, rng.choice(["t1", "hot", "nobody", None]), day(rng.randrange(4), rng.randrange(60)))
             for i in range(60)]
    log = spark.createDataFrame(log, "lsn long, op string, ticket_id string, passenger_name string, "
                                     "created_at timestamp_ntz, expires_at timestamp_ntz")
    asked = spark.createDataFrame(asked, "request_id long, ticket_id string, ts timestamp_ntz")
    rows = keyed.record_rows(log).unionByName(keyed.request_rows(asked))
    for hour in range(4):
        part = rows.where(f"hour(at) = {hour}")
        for half in (0, 1):
            write(spark, part.where(f"id % 2 = {half}"), tmp + "/in")
        assert run(spark, tmp, keyed.live_validation, rows.schema, "1 hour") == 0
    early = keyed.results(spark, tmp + "/out").count()
    assert 0 < early < 60                       # later requests still wait
    tick = spark.createDataFrame([("", dt.datetime(2024, 1, 3), 0, 0, keyed.TICK, None, None, None)], keyed.ROWS)
    write(spark, tick, tmp + "/in")
    run(spark, tmp, keyed.live_validation, rows.schema, "1 hour")
    want = tickets.validate_log(log, asked)
    got = keyed.results(spark, tmp + "/out").select(*want.columns)
    assert listed(got) == listed(want)
    late = spark.createDataFrame([("t1", day(1), 0, 999, keyed.REQUEST, None, None, None)], keyed.ROWS)
    write(spark, late, tmp + "/in")
    assert run(spark, tmp, keyed.live_validation, rows.schema, "1 hour") == 1
    assert listed(keyed.results(spark, tmp + "/out").select(*want.columns)) == listed(want)


def test_start_leaves_the_session_settings(spark, tmp):
    before = spark.conf.get(keyed.PROVIDER, None)
    source = spark.createDataFrame([("t", day(1), 0, 1, 1, None, None, None)], keyed.ROWS)
    write(spark, source, tmp + "/in")
    run(spark, tmp, keyed.live_validation, source.schema, "1 second")
    assert spark.conf.get(keyed.PROVIDER, None) == before


def test_first_wins_stream_over_restarts(spark, tmp):
    schema = "value string, at timestamp, id long"

    def msg(oid, user, at, i, quantity="1"):
        return ('{"order_id": "%s", "user": "%s", "item": "x", "quantity": %s}' % (oid, user, quantity), at, i)

    arrivals = [[msg("o1", "late-copy", day(1, 30), 2), msg("o2", "first", day(1, 10), 3)],
                [msg("o1", "first", day(1, 5), 1), msg("o3", "bad", day(1, 6), 4, '"x"'), ("{", day(1, 7), 5)],
                [msg("o2", "again", day(3), 6), msg("o3", "first", day(3), 7)],
                [msg("end", "", day(9), 8)]]
    for a in arrivals:
        write(spark, spark.createDataFrame(a, schema), tmp + "/in")
        run(spark, tmp, keyed.first_wins, spark.createDataFrame([], schema).schema, "1 hour")
    got = keyed.results(spark, tmp + "/out")
    assert sorted((r.order_uuid, r.username) for r in got.collect()) == [("o1", "first"), ("o2", "first"), ("o3", "first")]
