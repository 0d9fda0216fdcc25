"""Registered queries on timestamp_ntz data must not depend on the session
time zone (the checker may run with any zone)."""

import __spark_entry__ as E
from tests.test_registry import _digest

SF = "/root/testdata/sf0.001"


def test_swept_validation_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = {}
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = E.queries()["validate_swept"](spark, SF)
            res[tz] = _digest(df.columns, [tuple(r) for r in df.collect()])
        assert len(set(res.values())) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_micros_ntz_in_dst_gap(spark):
    from pyspark.sql import functions as F
    from lakeops.functions.exprs import epoch_micros
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        v = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' as t").select(
            epoch_micros(F.col("t"), True)).collect()[0][0]
        assert v == 1710037800123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
