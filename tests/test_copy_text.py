"""The tab-separated text of bulk loaders: exact round trip, the format against
a character-by-character reader, bad lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sinks.copy_text import read_copy, split_copy, write_copy

TEXT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("t", T.StringType())])


def by_hand(field):
    """COPY's text format, one character at a time."""
    if field == "\\N":
        return None
    out, i = [], 0
    while i < len(field):
        c = field[i]
        if c == "\\":
            i += 1
            c = {"b": "\b", "t": "\t", "n": "\n", "v": "\x0b", "f": "\f", "r": "\r"}.get(field[i], field[i])
        out.append(c)
        i += 1
    return "".join(out)


def awkward(n, seed=5):
    rnd = random.Random(seed)
    fixed = [None, "", "\\N", "\\", "\\\\", "\\t", "\t", "\n", "\r\n", "\x0b\f\b", "N", "\\\\N", "a\\\nb", "é\u2028\x85x",
             "x" * 200_000 + "\\", "\\." , "$1", "\\$1", "\\x41"]
    return fixed + ["".join(rnd.choice("\\\\\t\n\rNtnx$1 é") for _ in range(rnd.randrange(12))) for _ in range(n)]


def test_every_text_comes_back(spark, tmp):
    texts = awkward(400)
    df = spark.createDataFrame(list(enumerate(texts)), TEXT).repartition(3)
    write_copy(df, tmp + "/c")
    write_copy(df.where("id < 0"), tmp + "/c")
    back = {r.id: r.t for r in read_copy(spark, tmp + "/c", TEXT).collect()}
    assert back == dict(enumerate(texts))
    rows, bad = split_copy(spark, tmp + "/c", TEXT)
    assert rows.count() == len(texts) and bad.count() == 0


def test_lines_read_as_the_format_says(spark, tmp):
    texts = awkward(200, seed=9)
    write_copy(spark.createDataFrame(list(enumerate(texts)), TEXT), tmp + "/c")
    lines = [r.value for r in spark.read.option("lineSep", "\n").text(tmp + "/c").collect()]
    assert len(lines) == len(texts)
    for line in lines:
        i, field = line.split("\t")
        assert by_hand(field) == texts[int(i)]


def test_types_and_clashing_names(spark, tmp):
    schema = T.StructType([T.StructField("value", T.IntegerType()), T.StructField("f", T.DoubleType()),
                           T.StructField("reason", T.BooleanType()), T.StructField("d", T.DateType()),
                           T.StructField("a.b", T.TimestampNTZType()), T.StructField("m", T.DecimalType(20, 4))])
    rows = [(1, 1e-9, True, dt.date(2024, 2, 29), dt.datetime(2024, 1, 1, 2, 3, 4, 5), None),
            (None, float("inf"), None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    write_copy(df, tmp + "/c")
    assert sorted(map(tuple, read_copy(spark, tmp + "/c", schema).collect()), key=repr) == sorted(rows, key=repr)


def test_bad_lines_are_named(spark, tmp):
    good = ["1\ta", "2\t\\N", "3\t"]
    bad = {"4": "wrong number of fields", "4\ta\tb": "wrong number of fields", "": "wrong number of fields",
           "x\ta": "field 1 is no bigint", "\\N\ta": "field 1 is null", "5\ta\\x41": "unknown escape",
           "6\t\\\\\\101": "unknown escape", "7\ta\\": "unknown escape", "\\\t8": "unknown escape"}
    spark.createDataFrame([(v,) for v in good + list(bad)], "value string").write.text(tmp + "/c")
    rows, lines = split_copy(spark, tmp + "/c", TEXT)
    assert sorted((r.id, r.t) for r in rows.collect() if r.t is not None) == [(1, "a"), (3, "")]
    assert rows.count() == 3
    assert {r.value: r.reason for r in lines.collect()} == bad
    # a load is whole or not at all, whatever columns are asked for
    for columns in ("id", "t"):
        with pytest.raises(Exception, match="unknown escape|wrong number|field 1"):
            read_copy(spark, tmp + "/c", TEXT).select(columns).collect()
    with pytest.raises(Exception):
        read_copy(spark, tmp + "/c", TEXT).agg(F.count(F.lit(1))).collect()


def test_empty_and_nested(spark, tmp):
    df = spark.createDataFrame([], TEXT)
    write_copy(df, tmp + "/c")
    assert read_copy(spark, tmp + "/c", TEXT).count() == 0
    with pytest.raises(ValueError, match="text form: l"):
        write_copy(spark.range(1).select(F.array("id").alias("l")), tmp + "/d")
