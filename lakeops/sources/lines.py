"""Dense line numbers over text files.

Spark gives a line no number: a file is read in splits, and a split does not
know how many lines stand ahead of it. Two passes over the splits do: the first
counts the lines of every split, a prefix sum over one row per split says where
each starts, and the second adds a line's place inside its split. No line is
shuffled or sorted, and the numbers equal ``enumerate`` over the files in order of
their paths for every split size.

A line's place inside its split is its row id less the first row id that the
first pass saw in the split. Both passes plan the same splits, since they read the
same files under the same settings; should they not, a number falls outside its
split's range and the job fails rather than number wrongly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINES = "value string, line long, file string"
_SPLIT = ["_file", "_start"]


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their split and row id. A path may be a folder."""
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))


def split_starts(lines: DataFrame) -> DataFrame:
    """(_file, _start, _first, _lines, _before): a row per split with lines."""
    splits = lines.groupBy(*_SPLIT).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    # over one row per split
    before = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))


def numbered_lines(spark: SparkSession, paths: str | list[str], first: int = 0) -> DataFrame:
    """(value, line, file): every line, blank ones too, numbered from
    ``first`` without gaps through the files in order of their paths."""
    lines = _scan(spark, [paths] if isinstance(paths, str) else paths)
    place = F.col("_row") - F.col("_first")
    inside = (place >= 0) & (place < F.col("_lines"))
    number = F.when(inside, F.col("_before") + place + F.lit(first)).otherwise(
        F.raise_error(F.lit("the files' splits changed between the two passes over them")).cast("long"))
    return (lines.join(split_starts(lines), _SPLIT)
            .select("value", number.alias("line"), F.col("_file").alias("file")))
