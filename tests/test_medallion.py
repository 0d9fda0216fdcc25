import datetime as dt

from lakeops import schemas
from lakeops.plans import medallion
from tests.conftest import rows

T = dt.datetime(2024, 5, 1, 12, 0, 0)
AS_OF = "2024-06-01 00:00:00"


def source(spark, data):
    return spark.createDataFrame(data, schemas.EVENT_SOURCE)


EDGE = [
    ("e1", "m1", "Red", "p1", "GOAL", T),
    ("e2", "m1", "Red", "p2", "own goal", T),
    ("e3", "m1", "Red", "p3", "shot_goal", T),        # goal and shot
    ("e4", "m1", "Blue", "p4", "pass", T),            # counts as none
    ("e5", "m1", "Blue", "p5", None, T),              # dropped
    ("e6", "m1", None, "p6", "Foul", T),              # NULL team group
    ("e7", "m1", "Blue", "p7", "Shot", T),
    ("e8", "m1", "Blue", "p8", "Shot", T),            # same match/team/type/time: collapses
    ("e9", "m2", "Red", "p9", "foul", None),
    ("e10", "m2", "Red", "p10", "foul", None),        # two NULL times collapse at as_of
]


def test_layers(spark):
    b = medallion.bronze(source(spark, EDGE))
    assert b.columns == ["event_id", "match_id", "team", "player", "event_type", "timestamp"]
    assert b.count() == 10
    s = medallion.silver(b, AS_OF)
    assert s.count() == 7
    assert s.where("timestamp = TIMESTAMP_NTZ'2024-06-01 00:00:00'").count() == 1
    g = medallion.gold(s)
    assert rows(g, "team", "total_goals", "total_fouls", "total_shots") == sorted([
        ("Red", 3, 1, 1), ("Blue", 0, 0, 1), (None, 0, 1, 0)], key=repr)


def test_empty_source_and_run(spark, tmp):
    empty = source(spark, [])
    r = medallion.run(empty, tmp + "/empty", AS_OF)
    assert rows(r) == sorted([("bronze", 0), ("silver", 0), ("gold", 0)], key=repr)
    r = medallion.run(source(spark, EDGE), tmp + "/full", AS_OF)
    assert dict(rows(r)) == {"bronze": 10, "silver": 7, "gold": 3}
    # idempotent rerun (full refresh)
    r = medallion.run(source(spark, EDGE), tmp + "/full", AS_OF)
    assert dict(rows(r)) == {"bronze": 10, "silver": 7, "gold": 3}
    assert medallion.read_layer(spark, tmp + "/full", "silver").schema == schemas.SILVER


def test_a_reader_during_a_refresh_sees_a_whole_layer(spark, tmp):
    medallion.run(source(spark, EDGE), tmp + "/m", AS_OF)
    held = medallion.read_layer(spark, tmp + "/m", "bronze")
    medallion.run(source(spark, EDGE[:3]), tmp + "/m", AS_OF)
    assert held.count() == 10 and medallion.read_layer(spark, tmp + "/m", "bronze").count() == 3
    # an attempt that has not been committed is never read
    source(spark, EDGE).write.parquet(tmp + "/m/bronze/v=00000000000000000009/_temporary/0")
    assert medallion.read_layer(spark, tmp + "/m", "bronze").count() == 3


def test_run_into_a_catalog(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS medallion_t LOCATION '{tmp}/db'")
    try:
        for n in (10, 3):       # a second run replaces the tables
            r = medallion.run(source(spark, EDGE[:n]), as_of=AS_OF, database="medallion_t")
            assert dict(rows(r))["bronze"] == n
            assert spark.table("medallion_t.bronze").count() == n
        assert medallion.read_layer(spark, None, "silver", "medallion_t").schema == schemas.SILVER
    finally:
        spark.sql("DROP DATABASE medallion_t CASCADE")
