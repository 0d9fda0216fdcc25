import pytest
import datetime as dt
import json

from pyspark.sql import functions as F

from lakeops.plans import tickets
from lakeops.sinks.logs import append_validation_lines, publish_files, to_message_value
from lakeops.sinks.tables import bulk_load, insert_ignore, write_ctas, write_full_refresh
from lakeops.sources.jsonlog import read_text_or_empty
from lakeops.streaming import orders as stream
from tests.conftest import rows

UTC = dt.timezone.utc


def test_full_refresh_keeps_schema_and_ctas(spark, tmp):
    from lakeops import schemas
    df = spark.createDataFrame([("1", "m", "t", "p", "GOAL", None)],
                               "event_id string, match_id string, team string, player string, "
                               "event_type string, event_ts timestamp_ntz")
    write_full_refresh(df.withColumnRenamed("event_ts", "timestamp"), tmp + "/b",
                       schema=schemas.BRONZE)
    write_full_refresh(df.withColumnRenamed("event_ts", "timestamp"), tmp + "/b",
                       schema=schemas.BRONZE)
    b = spark.read.parquet(tmp + "/b")
    assert b.count() == 1 and b.columns == [f.name for f in schemas.BRONZE.fields]
    write_ctas(b.groupBy("team").count(), tmp + "/g")
    assert spark.read.parquet(tmp + "/g").columns == ["team", "count"]


def test_bulk_load_appends(spark, tmp):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    bulk_load(df, tmp + "/p")
    bulk_load(df, tmp + "/p")
    assert spark.read.parquet(tmp + "/p").count() == 20
    bulk_load(df, tmp + "/t", tsv=True)
    t = spark.read.option("sep", "\t").csv(tmp + "/t")
    assert t.count() == 10 and len(t.columns) == 2


def test_insert_ignore_on_stored_target(spark, tmp):
    a = spark.createDataFrame([("k1", 1, "a"), ("k1", 0, "first"), ("k2", 2, "b")],
                              "order_uuid string, pos int, v string")
    added = insert_ignore(a, tmp + "/o", ["order_uuid"], ["pos"])
    assert rows(added, "order_uuid", "v") == [("k1", "first"), ("k2", "b")]
    b = spark.createDataFrame([("k1", 5, "late"), ("k3", 1, "c")], a.schema)
    insert_ignore(b, tmp + "/o", ["order_uuid"], ["pos"])
    insert_ignore(b, tmp + "/o", ["order_uuid"], ["pos"])          # rerun: no change
    assert rows(spark.read.parquet(tmp + "/o"), "order_uuid", "v") == [
        ("k1", "first"), ("k2", "b"), ("k3", "c")]


def test_validation_log_write_and_read(spark, tmp):
    assert read_text_or_empty(spark, tmp + "/missing").count() == 0
    v = spark.createDataFrame([
        (1, "a", dt.datetime(2024, 1, 1, 10, 0, 0, 5, tzinfo=UTC), "valid", "Ann", None)],
        "request_id long, ticket_id string, ts timestamp, status string, "
        "passenger_name string, expires_at timestamp")
    append_validation_lines(v, tmp + "/tx")
    append_validation_lines(v, tmp + "/tx")
    lines = read_text_or_empty(spark, tmp + "/tx")
    assert lines.count() == 2
    back = tickets.parse_validation_lines(lines).collect()
    assert back[0].validated_at == "2024-01-01 10:00:00.000005+00:00"


def test_message_value_is_json(spark):
    df = spark.createDataFrame([("o1", "Sergi", "Pineapple", 7)],
                               "order_id string, user string, item string, quantity int")
    v = to_message_value(df).collect()[0].value
    assert json.loads(v) == {"order_id": "o1", "user": "Sergi", "item": "Pineapple", "quantity": 7}


def test_published_values_are_whole_and_counted(spark, tmp):
    df = spark.createDataFrame([("o1", None, "a\tb\n", 7), ("o2", "u", None, None)],
                               "order_id string, user string, item string, quantity int")
    assert publish_files(df, tmp + "/topic") == 2
    assert publish_files(df.limit(0), tmp + "/topic") == 0
    got = sorted((json.loads(r.value) for r in spark.read.text(tmp + "/topic").collect()), key=str)
    assert got == [{"order_id": "o1", "user": None, "item": "a\tb\n", "quantity": 7},
                   {"order_id": "o2", "user": "u", "item": None, "quantity": None}]


def test_dedup_state_option(spark, tmp):
    import os
    src = tmp + "/in"
    os.makedirs(src)
    with open(src + "/a.json", "w") as f:
        f.write("\n".join(json.dumps({"order_id": k, "user": "u", "item": "i", "quantity": 1})
                          for k in ["x", "x", "y"]) + "\n")
    s = stream.dedup_state(stream.file_source(spark, src).select("value"))
    q = (s.writeStream.format("memory").queryName("dedup_state_t")
         .option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.order_uuid for r in spark.table("dedup_state_t").collect()) == ["x", "y"]


def test_anti_join_probe_and_shuffle_agree(spark):
    from lakeops.operators.joins import anti_join
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    old = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    want = [(None, 3), ("b", 2), ("c", 4)]
    assert rows(anti_join(new, old, ["k"]), "k", "v") == sorted(want, key=repr)
    assert rows(anti_join(new, old, ["k"], small=True), "k", "v") == sorted(want, key=repr)


def test_a_failing_read_is_no_empty_target(spark, tmp):
    """A target that can't be read stops the insert and stays as it was."""
    import os

    from lakeops.sinks.tables import insert_ignore
    new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    target = tmp + "/t"
    insert_ignore(new, target, ["k"], ["v"])
    with open(target + "/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 not a parquet file PAR1")
    with pytest.raises(Exception):
        insert_ignore(new, target, ["k"], ["v"])
    os.replace(target + "/part-broken.parquet", tmp + "/broken")
    assert spark.read.parquet(target).count() == 2
    insert_ignore(new, target, ["k"], ["v"])
    assert spark.read.parquet(target).count() == 2


def test_a_failing_read_stops_the_order_stream(spark, tmp):
    from lakeops.streaming import orders as stream
    line = '{"order_id": "x", "user": "u", "item": "i", "quantity": 1}'
    batch = spark.createDataFrame([(line,)], "value string")
    for buckets in (8, None):
        target = f"{tmp}/t{buckets}"
        stream.process_batch(batch, 0, target, tmp + "/q", buckets=buckets)
        at = next(str(p.parent) for p in __import__("pathlib").Path(target).rglob("*.parquet"))
        with open(at + "/part-broken.parquet", "wb") as f:
            f.write(b"PAR1 not a parquet file PAR1")
        with pytest.raises(Exception):
            stream.process_batch(batch, 1, target, tmp + "/q", buckets=buckets)
        good = [str(p) for p in __import__("pathlib").Path(target).rglob("*.parquet") if "broken" not in p.name]
        assert spark.read.parquet(*good).count() == 1


def test_dedup_state_with_watermark(spark, tmp):
    import os
    src = tmp + "/in"
    os.makedirs(src)
    with open(src + "/a.json", "w") as f:
        f.write("\n".join(json.dumps({"order_id": k, "user": "u", "item": "i", "quantity": 1})
                          for k in ["x", "x", "y", "y", "z"]) + "\n")
    raw = spark.readStream.format("text").load(src).select(
        "value", F.col("_metadata.file_modification_time").alias("event_time"))
    s = stream.dedup_state(raw, watermark_col="event_time", delay="1 hour")
    q = (s.writeStream.format("memory").queryName("dedup_wm_t")
         .option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.order_uuid for r in spark.table("dedup_wm_t").collect()) == ["x", "y", "z"]
