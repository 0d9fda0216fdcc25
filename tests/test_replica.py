import json
import pytest
import os

from lakeops.sinks import bucketed
from lakeops.streaming import replica
from tests.conftest import rows


def rec(batch, seq, op, tid, name=None):
    r = {"op": op, "ticket_id": tid, "lsn": {"batch": batch, "seq": seq}}
    if op == "CREATE":
        r.update(passenger_name=name, created_at="2024-01-01T10:00:00+00:00",
                 expires_at="2024-01-01T11:00:00+00:00")
    return json.dumps(r)


def put(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_sync_stream_folds_with_tombstones(spark, tmp):
    log, base = tmp + "/wal", tmp + "/replica"
    put(log, "0001.log", [rec(1, 0, "CREATE", "a", "Ann"), rec(1, 1, "CREATE", "b", "Bob")])

    def run():
        q = replica.start_sync(spark, log, base, checkpoint=tmp + "/ck",
                               trigger={"availableNow": True})
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    assert rows(replica.current_tickets(spark, base), "ticket_id") == [("a",), ("b",)]
    put(log, "0002.log", [rec(2, 0, "DELETE", "a"), "garbage", rec(2, 1, "CREATE", "c", "Cy")])
    run()
    assert rows(replica.current_tickets(spark, base), "ticket_id") == [("b",), ("c",)]
    # a late file with an older CREATE of a cannot revive it (tombstone wins)
    put(log, "0003.log", [rec(1, 5, "CREATE", "a", "Old")])
    run()
    assert rows(replica.current_tickets(spark, base), "ticket_id") == [("b",), ("c",)]
    ids = spark.createDataFrame([("b",), ("zz",)], "ticket_id string")
    assert rows(replica.lookup(spark, base, ids), "ticket_id", "status") == [
        ("b", "found"), ("zz", "not_found")]
    assert len(bucketed.versions(spark, base)) <= 2


def test_sync_now(spark, tmp):
    base = tmp + "/snap"
    assert replica.sync_now(spark, tmp + "/missing", base) == 0
    put(tmp + "/wal", "0001.log", [rec(1, 0, "CREATE", "a", "Ann"), rec(1, 1, "DELETE", "a"),
                                   rec(1, 2, "CREATE", "b", "Bob")])
    assert replica.sync_now(spark, tmp + "/wal", base) == 1


def test_foreign_log_without_lsn_and_change_detection(spark, tmp):
    import time
    log = tmp + "/wal.log"
    plain = [json.dumps({"op": "CREATE", "ticket_id": t, "passenger_name": t.upper(),
                         "created_at": "2024-01-01T10:00:00+00:00",
                         "expires_at": "2024-01-01T11:00:00+00:00"}) for t in ("a", "b")]
    with open(log, "w") as f:
        f.write("\n".join(plain) + "\n")
    n, sig = replica.sync_if_changed(spark, log, tmp + "/snap")
    assert n == 2
    assert replica.sync_if_changed(spark, log, tmp + "/snap", sig)[0] is None
    time.sleep(1.1)
    with open(log, "a") as f:
        f.write(json.dumps({"op": "DELETE", "ticket_id": "a"}) + "\n")
    n, sig = replica.sync_if_changed(spark, log, tmp + "/snap", sig)
    assert n == 1
    assert [r.ticket_id for r in replica.current_tickets(spark, tmp + "/snap").collect()] == ["b"]
    os.remove(log)
    n, _ = replica.sync_if_changed(spark, log, tmp + "/snap", sig)
    assert n == 0


def test_replayed_sync_batch_changes_nothing(spark, tmp):
    base = tmp + "/rep"
    lines = [rec(1, 0, "CREATE", "a", "Ann"), rec(1, 1, "CREATE", "b", "Bob"),
             rec(1, 2, "DELETE", "a")]
    batch = spark.createDataFrame([(x,) for x in lines], "value string")
    replica._sync_batch(batch, 0, base)
    first = rows(replica.current_tickets(spark, base))
    replica._sync_batch(batch, 0, base)          # the same epoch again (retry)
    assert rows(replica.current_tickets(spark, base)) == first == [
        ("b", "Bob", "2024-01-01T10:00:00+00:00", "2024-01-01T11:00:00+00:00")]


def test_fold_probe_and_full_paths_agree(spark):
    import random
    rnd = random.Random(4)

    def recs(batch, n):
        out = []
        for i in range(n):
            tid = f"t{rnd.randint(0, 60)}"
            op = rnd.choice(["CREATE", "CREATE", "DELETE", "X"])
            out.append(rec(batch, i, op, tid, f"n{batch}-{i}") if op == "CREATE" else
                       json.dumps({"op": op, "ticket_id": tid, "lsn": {"batch": batch, "seq": i}}))
        return spark.createDataFrame([(x,) for x in out], "value string")

    from lakeops import schemas
    from lakeops.sources.jsonlog import parse_records
    s_probe = s_full = spark.createDataFrame([], replica.STATE_SCHEMA)
    for b in range(3):
        r = parse_records(recs(b, 80), schemas.LOG_RECORD, explicit_lsn=True)
        s_probe = spark.createDataFrame(replica.fold(s_probe, r).collect(), replica.STATE_SCHEMA)
        s_full = spark.createDataFrame(replica.fold(s_full, r, max_probe_bytes=-1).collect(),
                                       replica.STATE_SCHEMA)
    assert rows(s_probe) == rows(s_full)


def test_primary_to_replica_end_to_end(spark, tmp):
    """pay -> CREATE records in the log -> replica stream; sweep -> DELETE
    records -> replica stream; lookups on the replica."""
    import datetime as dt
    from lakeops.plans import tickets
    from lakeops.sources.jsonlog import read_log
    utc = dt.timezone.utc
    log_dir, base = tmp + "/wal", tmp + "/replica"
    pays = spark.createDataFrame(
        [("Ann", dt.datetime(2024, 1, 1, 9, 0, tzinfo=utc)),
         ("Bob", dt.datetime(2024, 1, 1, 11, 0, tzinfo=utc))],
        "passenger_name string, paid_at timestamp")
    issued = tickets.issue_to_log(pays, log_dir, 1, ["passenger_name", "paid_at"])

    def sync():
        q = replica.start_sync(spark, log_dir, base, checkpoint=tmp + "/ck",
                               trigger={"availableNow": True})
        q.awaitTermination(120)
        assert q.exception() is None

    sync()
    assert sorted(r.passenger_name for r in replica.current_tickets(spark, base).collect()) == [
        "Ann", "Bob"]
    state = tickets.typed(tickets.replay(read_log(spark, log_dir, explicit_lsn=True)))
    tickets.sweep_to_log(state, "2024-01-01 11:30:00", log_dir, batch_id=2)   # Ann expired 10:00
    sync()
    ids = issued.select("ticket_id")
    got = {r.status for r in replica.lookup(spark, base, ids).collect()}
    assert got == {"found", "not_found"}
    assert [r.passenger_name for r in replica.current_tickets(spark, base).collect()] == ["Bob"]


def test_a_failing_read_keeps_the_snapshot(spark, tmp):
    """Only a missing log is an empty log."""
    os.makedirs(tmp + "/wal")
    with open(tmp + "/wal/a.log", "w") as f:
        f.write(rec(1, 1, "CREATE", "t1", "Ann") + "\n")
    base = tmp + "/replica"
    assert replica.sync_now(spark, tmp + "/wal", base) == 1
    with open(tmp + "/wal/b.log.gz", "wb") as f:
        f.write(b"\x1f\x8bnot gzip at all")
    with pytest.raises(Exception):
        replica.sync_now(spark, tmp + "/wal", base)
    assert replica.current_tickets(spark, base).count() == 1
    assert replica.sync_now(spark, tmp + "/gone", tmp + "/other") == 0


def test_a_batch_rewrites_only_its_buckets(spark, tmp):
    from lakeops.plans import tickets  # noqa: F401
    log_dir, base = tmp + "/wal", tmp + "/replica"
    os.makedirs(log_dir)

    def sync(name, lines):
        with open(f"{log_dir}/{name}.log", "w") as f:
            f.write("\n".join(lines) + "\n")
        q = replica.start_sync(spark, log_dir, base, checkpoint=tmp + "/ck", trigger={"availableNow": True})
        q.awaitTermination(120)
        assert q.exception() is None

    sync("a", [rec(1, i, "CREATE", f"t{i}", "x") for i in range(300)])
    v0, buckets, before = bucketed.current(spark, base, 1)
    assert buckets == replica.BUCKETS and len(before) > buckets // 2
    held = replica.current_tickets(spark, base)         # a reader that began before the next batch
    sync("b", [json.dumps({"op": "DELETE", "ticket_id": "t7", "lsn": {"batch": 2, "seq": 1}})])
    v1, _, after = bucketed.current(spark, base, 1)
    assert v1 == v0 + 1 and [b for b in after if after[b] != before[b]] == [b for b in after if after[b] == v1]
    assert sum(v == v1 for v in after.values()) == 1
    assert held.count() == 300 and replica.current_tickets(spark, base).count() == 299
    sync("c", ["{oops}"])                               # nothing to fold: no new snapshot
    assert bucketed.current(spark, base, 1)[0] == v1
