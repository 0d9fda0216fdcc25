import json
import os

from pyspark.sql import functions as F

from lakeops.plans import orders
from lakeops.streaming import orders as stream
from tests.conftest import rows


def msg(oid, user="Sergi", item="Pineapple", qty=7):
    return json.dumps({"order_id": oid, "user": user, "item": item, "quantity": qty})


def test_decode_edges(spark):
    data = [
        (0, msg("a", qty=2.5)), (1, msg("b", qty="7")), (2, msg("c", qty="abc")),
        (3, msg("d", qty=None)), (4, msg("e", user="u" * 101)), (5, "not json"),
        (6, None), (7, json.dumps({"user": "x", "item": "y", "quantity": 1})),
        (8, msg(None)), (9, msg("f", qty=True)),
        (10, msg("g", qty="2.5")), (11, msg("h", qty=" +8 ")), (12, msg("i", qty=-2.5)),
        (13, msg("j", qty=3_000_000_000)), (14, msg("k", qty=1e2)),
    ]
    m = spark.createDataFrame(data, "offset long, value string")
    got = {r.offset: (r.order_uuid, r.quantity, r.reject_reason)
           for r in orders.decode(m, ["offset"]).collect()}
    assert got[0] == ("a", 3, None)
    assert got[1] == ("b", 7, None)
    assert got[2][2] == "bad quantity"
    assert got[3] == ("d", None, None)
    assert got[4][2] == "user too long"
    assert got[5][2] == "not a JSON object"
    assert got[6][2] == "null message"
    assert got[7][2] == "missing order_id"
    assert got[8][2] == "missing order_id"
    assert got[9][2] == "bad quantity"
    assert got[10][2] == "bad quantity"          # integer text required
    assert got[11] == ("h", 8, None)
    assert got[12] == ("i", -3, None)             # half away from zero
    assert got[13][2] == "bad quantity"          # out of INTEGER range
    assert got[14] == ("k", 100, None)


def test_first_wins_and_existing_wins(spark):
    m = spark.createDataFrame([
        (0, 1, msg("a", item="first")), (0, 2, msg("a", item="second")),
        (1, 0, msg("b", item="only")), (0, 3, msg("c", item="new")),
    ], "partition int, offset long, value string")
    existing = spark.createDataFrame([("c",)], "order_uuid string")
    out = orders.orders_to_insert(m, existing, ["partition", "offset"], as_of="2024-01-01 00:00:00")
    assert rows(out, "order_uuid", "item_name") == [("a", "first"), ("b", "only")]


def write_batch(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def run_once(spark, src, target, quar, ckpt):
    q = stream.start_ingest(stream.file_source(spark, src), target, quar, checkpoint=ckpt,
                            trigger={"availableNow": True}, as_of="2024-01-01 00:00:00")
    q.awaitTermination(120)
    assert q.exception() is None


def test_stream_ingest_two_runs_and_rerun(spark, tmp):
    src, target, quar, ckpt = tmp + "/in", tmp + "/orders", tmp + "/quarantine", tmp + "/ckpt"
    write_batch(src, "f-0001.json", [msg("a", item="first"), msg("a", item="dup-same-batch"),
                                     "not json", msg("b", qty="x")])
    run_once(spark, src, target, quar, ckpt)
    write_batch(src, "f-0002.json", [msg("a", item="late-dup"), msg("c")])
    run_once(spark, src, target, quar, ckpt)
    t = spark.read.parquet(target)
    assert rows(t, "order_uuid", "item_name") == [("a", "first"), ("c", "Pineapple")]
    assert spark.read.parquet(quar).count() == 2
    # a rerun of the same files with a fresh checkpoint adds nothing
    run_once(spark, src, target, quar, tmp + "/ckpt2")
    assert spark.read.parquet(target).count() == 2
    # replaying one batch by hand (a retried epoch) adds nothing either
    stream.process_batch(spark.read.text(src), 0, target, quar)
    assert spark.read.parquet(target).count() == 2


def test_stream_matches_python_loop(spark, tmp):
    """W1 model test: several random batches with repeated ids, bad rows and
    re-sent messages; the table must equal a row-by-row insert-or-ignore."""
    import random
    rnd = random.Random(9)
    src, target, quar, ckpt = tmp + "/in", tmp + "/orders", tmp + "/q", tmp + "/ck"
    model = {}
    for b in range(4):
        lines = []
        for _ in range(60):
            oid = f"o{rnd.randint(0, 80)}"
            kind = rnd.random()
            if kind < 0.1:
                line = "garbage"
            elif kind < 0.2:
                line = msg(oid, qty="abc")
            else:
                line = msg(oid, item=f"b{b}-{len(lines)}", qty=rnd.randint(1, 9))
                model.setdefault(oid, f"b{b}-{len(lines)}")
            lines.append(line)
        write_batch(src, f"f-{b:04d}.json", lines)
        run_once(spark, src, target, quar, ckpt)
    got = {r.order_uuid: r.item_name for r in spark.read.parquet(target).collect()}
    assert got == model


def test_bucketed_target_prunes_and_flat_option(spark, tmp):
    src = tmp + "/in"
    write_batch(src, "f-0001.json", [msg(f"id{i}") for i in range(50)])
    run_once(spark, src, tmp + "/o", tmp + "/q", tmp + "/ck")
    t = spark.read.parquet(tmp + "/o")
    assert stream.BUCKET_COL in t.columns and t.count() == 50
    assert t.select(stream.BUCKET_COL).distinct().count() > 10
    probe = t.where(F.col(stream.BUCKET_COL).isin([1, 2])).select("order_uuid")
    assert "PartitionFilters: [order_bucket" in \
        probe._jdf.queryExecution().executedPlan().toString()
    q = stream.start_ingest(stream.file_source(spark, src), tmp + "/flat", tmp + "/q2",
                            checkpoint=tmp + "/ck2", trigger={"availableNow": True}, buckets=None)
    q.awaitTermination(120)
    assert spark.read.parquet(tmp + "/flat").columns == [
        "order_uuid", "username", "item_name", "quantity", "created_at"]


def test_compact_target(spark, tmp):
    import glob as _glob
    src = tmp + "/in"
    for b in range(3):
        write_batch(src, f"f-{b:04d}.json", [msg(f"id{b}-{i}") for i in range(40)])
        run_once(spark, src, tmp + "/o", tmp + "/q", tmp + "/ck")
    before = len(_glob.glob(tmp + "/o/order_bucket=*/*.parquet"))
    n = stream.compact_target(spark, tmp + "/o", tmp + "/o2")
    after = len(_glob.glob(tmp + "/o2/order_bucket=*/*.parquet"))
    assert n == 120 and after < before
    assert rows(stream.read_target(spark, tmp + "/o2"), "order_uuid") == \
        rows(stream.read_target(spark, tmp + "/o"), "order_uuid")


def test_kafka_shaped_batch(spark, tmp):
    """A micro-batch shaped like the Kafka source (binary value, partition,
    offset): first wins by (partition, offset), binary values decoded."""
    import datetime as dt
    recs = [(None, msg("a", item="p0-o5").encode(), "orders", 0, 5, dt.datetime(2024, 1, 1)),
            (None, msg("a", item="p0-o2").encode(), "orders", 0, 2, dt.datetime(2024, 1, 1)),
            (None, msg("b").encode(), "orders", 1, 0, dt.datetime(2024, 1, 1)),
            (None, b"not json", "orders", 1, 1, dt.datetime(2024, 1, 1)),
            (None, None, "orders", 1, 2, dt.datetime(2024, 1, 1))]
    batch = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, "
                                        "offset long, timestamp timestamp")
    stream.process_batch(batch, 0, tmp + "/o", tmp + "/q", as_of="2024-01-02 00:00:00")
    got = rows(stream.read_target(spark, tmp + "/o"), "order_uuid", "item_name")
    assert got == [("a", "p0-o2"), ("b", "Pineapple")]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(tmp + "/q").collect())
    assert reasons == ["not a JSON object", "null message"]


def test_seq_decides_inside_a_batch_only(spark, tmp):
    """Two files, the later one with the smaller seq: in one micro-batch its
    message wins, in two the stored one stays."""
    import os
    import time

    from lakeops.streaming import orders as stream
    for name, seq in (("a", 5), ("b", 1)):
        os.makedirs(tmp + "/in", exist_ok=True)
        with open(f"{tmp}/in/{name}.json", "w") as f:
            f.write('{"seq": %d, "order_id": "o", "user": "%s", "item": "x", "quantity": 1}\n' % (seq, name))
        time.sleep(1.1)
    for most, winner in ((None, "b"), (1, "a")):
        out = f"{tmp}/out-{winner}"
        q = stream.start_ingest(stream.file_source(spark, tmp + "/in", most), out, out + "-bad", checkpoint=out + "-ck",
                                trigger={"availableNow": True})
        q.awaitTermination(120)
        assert q.exception() is None
        assert [r.username for r in stream.read_target(spark, out).collect()] == [winner]


def test_quantity_keeps_its_json_type(spark):
    """One parse tells numbers, texts and other values apart, with the last of
    repeated fields and only top-level ones."""
    cases = [("7", 7), ('"7"', 7), ("2.5", 3), ("2.4999999", 2), ("-2.5", -3), ('"2.5"', None), ("1e2", 100),
             ("1e40", None), ("true", None), ('"true"', None), ("null", None), ("[7]", None), ('{"a": 7}', None),
             ("2147483647", 2147483647), ("2147483647.5", None), ('"-8"', -8), ('7, "quantity": "8"', 8),
             ('"8x", "quantity": 7', 7), ('7, "x": {"quantity": "y"}', 7)]
    values = [(i, '{"order_id": "o", "quantity": %s}' % q) for i, (q, _) in enumerate(cases)]
    got = {r.offset: r for r in orders.decode(spark.createDataFrame(values, "offset int, value string"),
                                              ["offset"]).collect()}
    for i, (q, want) in enumerate(cases):
        assert got[i].quantity == want, q
        assert got[i].reject_reason == (None if want is not None or q == "null" else "bad quantity"), q
