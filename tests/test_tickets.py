import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeops.plans import tickets
from lakeops.sinks.logs import append_log
from lakeops.sources.jsonlog import bad_records, read_lines, read_log
from tests.conftest import rows

UTC = dt.timezone.utc


def iso(t):
    return t.isoformat()


def write_lines(path, lines, n_files=1):
    os.makedirs(path, exist_ok=True)
    per = (len(lines) + n_files - 1) // n_files
    for i in range(n_files):
        with open(os.path.join(path, f"part-{i:05d}.log"), "w") as f:
            f.write("\n".join(lines[i * per:(i + 1) * per]) + "\n")


T0 = dt.datetime(2024, 1, 1, 10, 0, tzinfo=UTC)


def create(tid, name="Ann", t=T0, with_exp=True):
    r = {"op": "CREATE", "ticket_id": tid, "passenger_name": name, "created_at": iso(t)}
    if with_exp:
        r["expires_at"] = iso(t + dt.timedelta(hours=1))
    return json.dumps(r)


def delete(tid):
    return json.dumps({"op": "DELETE", "ticket_id": tid})


def test_replay_edge_lines(spark, tmp):
    lines = [
        create("a"), delete("a"), create("a", "Ann2"),            # revived
        delete("ghost"),                                          # unknown id: nothing
        "", "not json", "[1]", create("x") + " trailing",          # skipped
        create("y") + delete("b"),                                # two objects: skipped
        create("b", "Bob | Jr"), json.dumps({"op": "UPGRADE", "ticket_id": "b"}),  # ignored
        json.dumps({"op": "CREATE", "passenger_name": "no id"}),
        json.dumps({"op": "CREATE", "ticket_id": "", "passenger_name": "empty id"}),
        create("c", with_exp=False),                              # nulls kept
        create("d"), delete("d"),
    ]
    write_lines(tmp + "/log", lines)
    log = read_log(spark, tmp + "/log")
    st = tickets.replay(log)
    got = {r.ticket_id: r.passenger_name for r in st.collect()}
    assert got == {"a": "Ann2", "b": "Bob | Jr", "c": "Ann"}
    assert st.where("ticket_id = 'c'").collect()[0].expires_at is None
    bad = [r.value for r in bad_records(read_lines(spark, tmp + "/log")).collect()]
    assert sorted(bad) == sorted(["not json", "[1]", create("x") + " trailing",
                                  create("y") + delete("b")])


def test_missing_log_is_empty(spark, tmp):
    assert tickets.replay(read_log(spark, tmp + "/nope")).count() == 0


def test_log_order_holds_across_many_splits(spark, tmp):
    # one ticket flipping CREATE/DELETE; the last line decides
    lines = []
    for i in range(4000):
        lines.append(create("t", f"n{i}") if i % 2 == 0 else delete("t"))
    lines.append(create("t", "final"))
    write_lines(tmp + "/log", lines, n_files=3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        log = read_log(spark, tmp + "/log")
        assert log.rdd.getNumPartitions() > 6
        assert rows(tickets.replay(log), "ticket_id", "passenger_name") == [("t", "final")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_explicit_lsn_roundtrip(spark, tmp):
    pays = spark.createDataFrame([("Ann", T0), ("Bob", T0 + dt.timedelta(minutes=5))],
                                 "passenger_name string, paid_at timestamp")
    recs = tickets.issue_tickets(pays, ["passenger_name", "paid_at"])
    out = recs.select("op", "ticket_id", "passenger_name",
                      F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("created_at"),
                      F.date_format("expires_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("expires_at"))
    append_log(out.orderBy("created_at"), tmp + "/wal", batch_id=1)
    bob = recs.where("passenger_name = 'Bob'").collect()[0].ticket_id
    dels = spark.createDataFrame([("DELETE", bob)], "op string, ticket_id string")
    append_log(dels, tmp + "/wal", batch_id=2)
    log = read_log(spark, tmp + "/wal", explicit_lsn=True)
    st = tickets.typed(tickets.replay(log)).collect()
    assert [r.passenger_name for r in st] == ["Ann"]
    assert st[0].expires_at - st[0].created_at == dt.timedelta(hours=1)


def ticket_state(spark, data):
    return spark.createDataFrame(data, "ticket_id string, passenger_name string, "
                                       "created_at timestamp, expires_at timestamp")


def test_validate_statuses(spark):
    h = dt.timedelta(hours=1)
    st = ticket_state(spark, [("a", "Ann", T0, T0 + h)])
    req = spark.createDataFrame([
        (1, "a", T0 + h),                     # exactly at expiry: valid
        (2, "a", T0 - h),                     # before creation: not_found
        (3, "a", T0 + 2 * h),                 # expired
        (4, "zz", T0),                        # unknown
    ], "request_id long, ticket_id string, ts timestamp")
    got = {r.request_id: (r.status, r.passenger_name) for r in tickets.validate(st, req).collect()}
    assert got == {1: ("valid", "Ann"), 2: ("not_found", None), 3: ("expired", None),
                   4: ("not_found", None)}


def test_expiry_sweep_strict(spark):
    h = dt.timedelta(hours=1)
    st = ticket_state(spark, [("a", "A", T0, T0 + h), ("b", "B", T0, T0 + 3 * h)])
    dels, rest = tickets.expiry_sweep(st, T0 + h)            # equal: not expired
    assert dels.count() == 0 and rest.count() == 2
    dels, rest = tickets.expiry_sweep(st, T0 + 2 * h)
    assert rows(dels) == [("DELETE", "a")] and rows(rest, "ticket_id") == [("b",)]


def brute_swept(state, reqs, mode):
    """Row-by-row model of validation with sweeps after requests."""
    live = dict(state)
    out = {}
    for rid, tid, t in sorted(reqs, key=lambda r: (r[2], r[0])):
        tk = live.get(tid)
        if tk is None or tk[0] > t:
            st = "not_found"
        elif t <= tk[1]:
            st = "valid"
        else:
            st = "expired"
        out[rid] = st
        if mode == "all" or st == "valid":
            for k in [k for k, v in live.items() if v[1] < t]:
                del live[k]
    return out


@pytest.mark.parametrize("mode", ["valid", "all"])
@pytest.mark.parametrize("seed", [1, 2])
def test_validate_swept_matches_loop(spark, mode, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, tzinfo=UTC)
    state = {}
    for i in range(40):
        c = base + dt.timedelta(minutes=rnd.randint(0, 600))
        state[f"t{i}"] = (c, c + dt.timedelta(minutes=rnd.randint(10, 120)))
    reqs = []
    hot = base + dt.timedelta(minutes=300)          # many requests at one instant
    for r in range(300):
        t = hot if r % 3 == 0 else base + dt.timedelta(minutes=rnd.randint(0, 800))
        reqs.append((r, f"t{rnd.randint(0, 45)}", t))
    st = ticket_state(spark, [(k, k.upper(), v[0], v[1]) for k, v in state.items()])
    rq = spark.createDataFrame(reqs, "request_id long, ticket_id string, ts timestamp")
    want = brute_swept(state, reqs, mode)
    for parts in (1, 7):
        got = {r.request_id: r.status for r in
               tickets.validate_swept(st, rq, mode, segments=parts).collect()}
        assert got == want


def test_validation_log_roundtrip(spark):
    v = spark.createDataFrame([
        (1, "a", dt.datetime(2024, 1, 1, 10, 0, 0, 123456, tzinfo=UTC), "valid", "Ann | Lee", None),
        (2, "b", dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=UTC), "valid", "Bob", None),
        (3, "c", dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=UTC), "expired", None, None),
    ], "request_id long, ticket_id string, ts timestamp, status string, "
       "passenger_name string, expires_at timestamp")
    lines = tickets.validation_lines(v)
    assert sorted(r.value for r in lines.collect()) == [
        "Ann | Lee | ticket a validated at 2024-01-01 10:00:00.123456+00:00",
        "Bob | ticket b validated at 2024-01-01 10:00:00+00:00"]
    back = tickets.parse_validation_lines(lines)
    assert rows(back, "ticket_id", "passenger_name") == [("a", "Ann | Lee"), ("b", "Bob")]


def test_lookup(spark):
    st = ticket_state(spark, [("a", "Ann", T0, T0)])
    ids = spark.createDataFrame([("a",), ("b",)], "ticket_id string")
    assert rows(tickets.lookup(st, ids), "ticket_id", "status") == [("a", "found"), ("b", "not_found")]


def test_two_equal_payments_are_two_tickets(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=UTC)
    pays = spark.createDataFrame([(1, "Ann", at), (2, "Ann", at)], "id long, passenger_name string, paid_at timestamp")
    assert tickets.issue_tickets(pays, ["id"]).select("ticket_id").distinct().count() == 2
    with pytest.raises(ValueError):
        tickets.issue_tickets(pays, [])
    keys = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("ab", None, None)],
                                 "x string, y string, z string")
    ids = keys.withColumn("passenger_name", F.lit("n")).withColumn("paid_at", F.lit(at))
    assert tickets.issue_tickets(ids, ["x", "y", "z"]).select("ticket_id").distinct().count() == 4


def brute_at_request(log, requests, mode=None):
    """The service's loop: one timeline of log records and requests, with the
    sweeps after each request if there is a mode."""
    state, swept, out = {}, set(), {}
    timeline = sorted([(t, i, 0, x) for i, t, *x in log] + [(t, i, 1, x) for i, t, *x in requests],
                      key=lambda e: (e[0], e[1], e[2]))
    for t, i, kind, x in timeline:
        if not kind:
            op, tid, expires = x
            if op == "CREATE":
                state[tid] = expires
            elif op == "DELETE":
                state.pop(tid, None)
            continue
        (tid,) = x
        out[i] = "not_found" if tid not in state else "valid" if t <= state[tid] else "expired"
        if mode and (mode == "all" or out[i] == "valid"):
            state = {k: e for k, e in state.items() if e >= t}
    return out


@pytest.mark.parametrize("mode", [None, "valid", "all"])
def test_requests_see_the_log_up_to_their_time(spark, mode):
    rnd = random.Random(6)
    base = dt.datetime(2024, 1, 1, tzinfo=UTC)
    at = lambda: base + dt.timedelta(minutes=rnd.choice([300, rnd.randint(0, 900)]))
    log, requests = [], []
    for i in range(900):
        tid = rnd.choice(["hot", f"t{rnd.randint(0, 30)}"])
        t = at()
        if rnd.random() < 0.4:
            op = rnd.choice(["CREATE", "CREATE", "DELETE", "CLICK"])
            log.append((i, t, op, tid, t + dt.timedelta(minutes=rnd.randint(1, 90))))
        else:
            requests.append((i, t, tid))
    lg = spark.createDataFrame([(i, op, tid, "n", t, e) for i, t, op, tid, e in log],
                               "lsn long, op string, ticket_id string, passenger_name string, "
                               "created_at timestamp, expires_at timestamp")
    rq = spark.createDataFrame([(i, tid, t) for i, t, tid in requests], "request_id long, ticket_id string, ts timestamp")
    for segments in (1, 5):
        got = tickets.validate_log(lg, rq, segments=segments) if mode is None else \
            tickets.validate_log_swept(lg, rq, mode, segments=segments)
        assert {r.request_id: r.status for r in got.collect()} == brute_at_request(log, requests, mode)


def test_state_as_of_a_time(spark):
    at = [dt.datetime(2024, 1, d, tzinfo=UTC) for d in (1, 2, 3)]
    lg = spark.createDataFrame([(1, "CREATE", "a", "n", at[0], at[1]), (2, "DELETE", "a", None, at[1], None),
                                (3, "CREATE", "b", "n", at[2], at[2])],
                               "lsn long, op string, ticket_id string, passenger_name string, "
                               "created_at timestamp, expires_at timestamp")
    ids = lambda t: {r.ticket_id for r in tickets.replay_as_of(lg, F.lit(t)).collect()}
    assert ids(at[0]) == {"a"} and ids(at[1]) == set() and ids(at[2]) == {"b"}
