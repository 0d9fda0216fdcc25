"""Dense line numbers, and following one growing file."""

import json
import os
import random

import pytest

from lakeops.plans import tickets
from lakeops.sources import tail
from lakeops.sources.lines import numbered_lines
from lakeops.streaming import replica

from .conftest import rows as listed


@pytest.mark.parametrize("split", [64, 333, 1 << 20])
def test_line_numbers_equal_enumerate(spark, tmp, split):
    rng = random.Random(split)
    os.makedirs(tmp + "/log")
    want, n = [], 0
    for name in ("b.log", "a.log", "c.log", "empty.log"):
        lines = ["".join(rng.choice("xyz é") for _ in range(rng.randrange(40))) for _ in range(rng.randrange(300))]
        if name == "empty.log":
            lines = []
        with open(f"{tmp}/log/{name}", "w") as f:
            f.write("\n".join(lines) + ("\n" if rng.random() < 0.7 and lines else ""))
    for name in sorted(os.listdir(tmp + "/log")):
        for line in open(f"{tmp}/log/{name}", newline="\n").read().splitlines():
            want.append((n, name, line))
            n += 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = numbered_lines(spark, tmp + "/log", first=5).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.line - 5, os.path.basename(r.file), r.value) for r in got) == want


def test_changed_splits_fail(spark, tmp):
    """Numbers are never taken from other splits than were counted."""
    from lakeops.sources import lines
    with open(tmp + "/a.log", "w") as f:
        f.write("".join(f"line {i}\n" for i in range(400)))
    scan = lines._scan(spark, [tmp + "/a.log"])
    counted = lines.split_starts(scan).withColumn("_first", lines.F.col("_first") + 1)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lines, "split_starts", lambda _: counted)
        with pytest.raises(Exception, match="splits changed"):
            numbered_lines(spark, tmp + "/a.log").collect()


def rec(op, tid, name=None):
    return json.dumps({"op": op, "ticket_id": tid, "passenger_name": name}) + "\n"


def state(spark, base):
    return {r.ticket_id: r.passenger_name for r in replica.current_tickets(spark, base).collect()}


def model(text):
    out = {}
    for line in text.split("\n")[:-1]:
        try:
            r = json.loads(line)
        except ValueError:
            continue
        if r["op"] == "CREATE":
            out[r["ticket_id"]] = r["passenger_name"]
        else:
            out.pop(r["ticket_id"], None)
    return out


def test_follow_reads_appended_bytes_only(spark, tmp, monkeypatch):
    log, base = tmp + "/wal.jsonl", tmp + "/replica"
    shipped = []
    real = tail._ship
    monkeypatch.setattr(tail, "_ship", lambda s, f, d, a, b: shipped.append((a, b)) or real(s, f, d, a, b))

    def append(text, mode="a"):
        with open(log, mode) as f:
            f.write(text)
        return replica.follow(spark, log, base)

    assert append(rec("CREATE", "a", "Ann") + rec("CREATE", "b", "Bob")) == 2
    assert state(spark, base) == {"a": "Ann", "b": "Bob"}
    assert replica.follow(spark, log, base) is None
    torn = rec("DELETE", "a")
    assert append(rec("CREATE", "c", "é" * 50) + "{oops}\n" + torn[:9]) == 2    # the torn line waits
    assert state(spark, base) == {"a": "Ann", "b": "Bob", "c": "é" * 50}
    assert append(torn[9:20]) is None
    assert append(torn[20:]) == 1
    assert state(spark, base) == {"b": "Bob", "c": "é" * 50}
    assert [b for _, b in shipped[:-1]] == [a for a, _ in shipped[1:]] and shipped[0][0] == 0
    assert append(rec("CREATE", "a", "back")) == 1
    assert state(spark, base)["a"] == "back"


def test_follow_a_file_cut_replaced_or_gone(spark, tmp):
    log, base = tmp + "/wal.jsonl", tmp + "/replica"

    def put(text, mode="w"):
        with open(log, mode) as f:
            f.write(text)
        return replica.follow(spark, log, base)

    assert replica.follow(spark, log, base) == 0 and state(spark, base) == {}      # no file yet
    assert replica.follow(spark, log, base) is None
    a, b, c = rec("CREATE", "a", "Ann"), rec("CREATE", "b", "Bob"), rec("CREATE", "c", "Cy")
    put(a + b)
    assert state(spark, base) == {"a": "Ann", "b": "Bob"}
    put(a + b[:5])                                                                  # cut in the middle of a line
    assert state(spark, base) == {"a": "Ann"}
    put(b[5:], "a")
    assert state(spark, base) == {"a": "Ann", "b": "Bob"}
    put(c + a + b + a)                                                              # longer, but another file
    assert state(spark, base) == {"a": "Ann", "b": "Bob", "c": "Cy"}
    put("")
    assert state(spark, base) == {}
    put(c, "a")
    assert state(spark, base) == {"c": "Cy"}
    os.remove(log)
    assert replica.follow(spark, log, base) == 0 and state(spark, base) == {}
    assert replica.follow(spark, log, base) is None
    put(b)
    assert state(spark, base) == {"b": "Bob"}


def test_follow_after_a_crash(spark, tmp, monkeypatch):
    """The snapshot is written, the position is not: the lines come again, with
    more behind them, and change nothing that stands."""
    log, base = tmp + "/wal.jsonl", tmp + "/replica"
    open(log, "w").write(rec("CREATE", "a", "1") + rec("DELETE", "a") + rec("CREATE", "b", "1"))
    with monkeypatch.context() as m:
        m.setattr(tail, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            replica.follow(spark, log, base)
    assert state(spark, base) == {"b": "1"}
    open(log, "a").write(rec("CREATE", "b", "2") + rec("CREATE", "a", "2"))
    replica.follow(spark, log, base)
    assert state(spark, base) == {"a": "2", "b": "2"}


def test_follow_random_growth(spark, tmp, monkeypatch):
    """Any cut of the bytes into polls gives the replay of the whole lines."""
    monkeypatch.setattr(tail, "_LOOK", 37)
    real = tail.poll
    monkeypatch.setattr(tail, "poll", lambda s, p, c: real(s, p, c, segment_bytes=200))
    rng = random.Random(1)
    text = "".join(rng.choice([rec("CREATE", f"t{rng.randrange(9)}", "n" * rng.choice([1, 500])),
                               rec("DELETE", f"t{rng.randrange(9)}"), "\n", "[1]\n"[:0] + "{bad\n"]) for _ in range(90))
    log, base, at = tmp + "/wal.jsonl", tmp + "/replica", 0
    data = text.encode()
    for _ in range(6):
        at = min(len(data), at + rng.randrange(len(data) // 4))
        with open(log, "wb") as f:
            f.write(data[:at])
        replica.follow(spark, log, base)
        assert state(spark, base) == model(data[:at].decode())
    segments = os.listdir(f"{base}/_tail/segments")
    assert len(segments) == 1 and not [f for f in os.listdir(f"{base}/_tail/segments/{segments[0]}")
                                       if f.endswith(".jsonl")]


def test_numbers_go_on_over_polls(spark, tmp):
    log, ck = tmp + "/wal.jsonl", tmp + "/ck"
    seen = []
    for i in range(3):
        with open(log, "a") as f:
            f.write("".join(rec("CREATE", f"t{i}{j}", "x") for j in range(20)))
        found = tail.poll(spark, log, ck, segment_bytes=300)
        assert len(found.segments) > 3
        seen += [(r.lsn.batch, r.lsn.seq, r.ticket_id) for r in tail.records_of(spark, found).collect()]
        tail.commit(spark, ck, found.after)
    assert sorted(seen) == [(0, i * 20 + j, f"t{i}{j}") for i in range(3) for j in range(20)]
    assert listed(tickets.replay(tail.records_of(spark, found)).limit(0)) == []
