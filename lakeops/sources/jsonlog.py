"""JSON-lines log readers (S5, S6) with a log sequence number.

Log order is line order. Spark has no line number, so each record gets an
``lsn`` column:
  * logs written by ``sinks.logs.append_log`` carry an explicit
    ``lsn = {batch, seq}`` field;
  * foreign logs get ``lsn = (file path, split start, row id in split)``:
    files must have names that sort in write order. Within a split rows keep
    file order; splits of one file sort by start offset.
A missing path gives an empty frame; a path that cannot be read is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.exprs import json_object_shape
from .paths import path_exists

LSN_EXPLICIT = T.StructType([T.StructField("batch", T.LongType()),
                             T.StructField("seq", T.LongType())])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with a derived lsn (file, split start, row id)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "value string, lsn struct<file:string,"
                                         "start:bigint,row:bigint>")
    raw = spark.read.text(path)
    return raw.select(
        "value",
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("start"),
                 F.monotonically_increasing_id().alias("row")).alias("lsn"))


_CORRUPT = "_corrupt_record"


def _decoded(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Every non-blank line with its decoded record ``r``: NULL unless the line
    is one well-formed JSON object. The record passes a generator, which filters
    on it are not pushed through, so each line is parsed once."""
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_json("value", T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]), options)
    some = lines.where(F.col("value").rlike(r"\S"))
    out = some.select("*", F.explode(F.array(F.struct(json_object_shape("value").alias("shape"),
                                                      record.alias("r")))).alias("_d"))
    good = F.col("_d.shape") & F.col("_d.r").isNotNull() & F.col(f"_d.r.{_CORRUPT}").isNull()
    return out.select(*lines.columns, F.when(good, F.col("_d.r")).alias("r"))


def parse_records(lines: DataFrame, schema: T.StructType = schemas.LOG_RECORD,
                  explicit_lsn: bool = False) -> DataFrame:
    """The records of the lines that are one well-formed JSON object; every
    other non-blank line is in ``bad_records``."""
    full = (T.StructType([*schema.fields, T.StructField("lsn", LSN_EXPLICIT)])
            if explicit_lsn else schema)
    rec = _decoded(lines, full).where(F.col("r").isNotNull())
    lsn = F.col("r.lsn").alias("lsn") if explicit_lsn else F.col("lsn")
    return rec.select(lsn, *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def bad_records(lines: DataFrame, schema: T.StructType = schemas.LOG_RECORD) -> DataFrame:
    """Non-blank lines that are no well-formed JSON object of this schema
    (quarantine / audit): arrays, scalars, trailing text, broken objects."""
    return _decoded(lines, schema).where(F.col("r").isNull()).drop("r")


def read_log(spark: SparkSession, path: str, explicit_lsn: bool = False,
             schema: T.StructType = schemas.LOG_RECORD) -> DataFrame:
    """The log as records (lsn, op, ticket_id, passenger_name,
    created_at, expires_at); times stay ISO text as written."""
    if explicit_lsn:
        if not path_exists(spark, path):
            fields = ", ".join(f"{f.name} string" for f in schema.fields)
            return spark.createDataFrame([], f"lsn struct<batch:bigint,seq:bigint>, {fields}")
        return parse_records(spark.read.text(path), schema, explicit_lsn=True)
    return parse_records(read_lines(spark, path), schema)


def read_text_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The validation log's lines; a missing file is an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path)
