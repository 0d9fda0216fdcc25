"""K4 as text: rows in the tab-separated form that database bulk loaders read
and write (COPY's text format), and back.

One row a line, fields parted by one tab. NULL is ``\\N``; in any other field a
backslash and the control characters \\b \\t \\n \\v \\f \\r are written as a
backslash with a letter, so a field never holds a raw tab or line end, an empty
text stays apart from NULL, and the text ``\\N`` is written ``\\\\N``. Numbers,
dates and booleans take Spark's text form.

Reading splits each line at its tabs and undoes the escapes in one pass over the
field. A line with another number of fields, an octal or hexadecimal escape (the
writer has none), a lone backslash at a field's end, or a field that its type
can't read, is no row: ``read_copy`` raises on it when it is reached, and
``split_copy`` gives it apart with the reason instead. An empty folder gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_FIELD = "\\N"
# fixed values of the format: control character -> letter after the backslash
ESCAPES = {"\b": "b", "\t": "t", "\n": "n", "\x0b": "v", "\f": "f", "\r": "r"}


def escaped(c: Column) -> Column:
    """A value as one field of a line."""
    text = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for char, letter in ESCAPES.items():
        text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return F.coalesce(text, F.lit(NULL_FIELD))


def unescaped(field: Column) -> Column:
    """The text of a field. Runs of backslashes pair up from the left, so the
    field is cut at each pair; in a part between pairs every backslash starts an
    escape of its own, and undoing one makes no new one."""
    def undo(part: Column) -> Column:
        for char, letter in ESCAPES.items():
            part = F.replace(part, F.lit("\\" + letter), F.lit(char))
        return F.regexp_replace(part, r"(?s)\\(.)", "$1")

    plain = F.instr(field, "\\") == 0
    return F.when(field == NULL_FIELD, None).when(plain, field).otherwise(
        F.array_join(F.transform(F.split(field, r"\\\\", -1), undo), "\\"))


def write_copy(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append the rows as text files, one a task; the columns' order is the
    fields' order. Nested columns have no text form and are refused."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if nested:
        raise ValueError(f"columns without a text form: {', '.join(nested)}")
    line = F.concat_ws("\t", *[escaped(F.col(f"`{c}`")) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def checked_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line under ``path`` with the schema's columns as ``_0``, ``_1``, ... and
    ``reason``, NULL for a good line."""
    lines = spark.read.option("lineSep", "\n").text(path).withColumn("f", F.split("value", "\t", -1))
    # an odd run of backslashes before an octal digit or x, or at a field's end
    strange = r"(?<!\\)(?:\\\\)*\\(?:[0-7x]|\t|\z)"
    reason = (F.when(F.size("f") != len(schema.fields), F.lit("wrong number of fields"))
              .when(F.col("value").rlike(strange), F.lit("unknown escape")))
    columns = []
    for i, f in enumerate(schema.fields):
        text = value = unescaped(F.get("f", F.lit(i)))
        if not isinstance(f.dataType, T.StringType):
            value = text.try_cast(f.dataType)
            reason = reason.when(text.isNotNull() & value.isNull(),
                                 F.lit(f"field {i + 1} is no {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = reason.when(text.isNull(), F.lit(f"field {i + 1} is null"))
        columns.append(value.alias(f"_{i}"))
    return lines.select("value", reason.alias("reason"), *columns)


def _rows(checked: DataFrame, schema: T.StructType) -> DataFrame:
    return checked.select(*[F.col(f"_{i}").alias(f.name) for i, f in enumerate(schema.fields)])


def split_copy(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines as ``value`` and ``reason``) of the files under ``path``."""
    checked = checked_copy(spark, path, schema)
    return (_rows(checked.where(F.col("reason").isNull()), schema),
            checked.where(F.col("reason").isNotNull()).select("value", "reason"))


def read_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows under ``path``. As a bulk load takes all lines or none, a bad line
    stops the job that reads it, whatever columns that job uses, and is named in
    the error."""
    checked = checked_copy(spark, path, schema)
    stop = F.raise_error(F.concat(F.col("reason"), F.lit(": "), F.col("value"))).cast("boolean")
    return _rows(checked.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(stop)), schema)
