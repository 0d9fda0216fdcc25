"""Helpers shared by the operators of this subpackage: reading a table,
written intermediate tables, and gapless numbering without one-task windows."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

# The white space that separates words: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\f\r"
# The same as a regular expression of one word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_made: list[list[str]] = []     # folders of the open scopes


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    path = shared_path(spark, "lakeops-llm", f"{name}-{uuid.uuid4().hex}")
    if _made:
        _made[-1].append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession):
    """A scope for running an operator and storing its result: the folders that
    ``run_folder`` named inside are deleted at its end, and only those. Results of
    operators are lazy and read such folders, so store them inside; a folder taken
    off the list that the scope gives is kept."""
    _made.append([])
    try:
        yield _made[-1]
    finally:
        jvm = spark.sparkContext._jvm
        for path in _made.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: what
    follows reads files that every executor sees, so a lost executor never
    makes the steps before run again."""
    path = run_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return the freed memory of a Python worker to the system, where the C
    library can: Spark keeps the worker for later tasks."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text; NULL counts as empty."""
    return F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the
    body uses it inside a lambda that runs for each element of an array."""
    return F.transform(F.array(value), body)[0]


def numbered(df: DataFrame, group: str, bucket: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each ``group``, in the order of
    (``bucket``, then ``order``). ``bucket`` cuts every group into about even
    parts, so a group with a third of all rows is numbered by many tasks: each
    part numbers its own rows and starts where the parts before it end. The
    running sum is over one row for each (group, bucket)."""
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_n"))
              .select(F.col(group).alias("_own_group"), F.col(bucket).alias("_own_part"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy(group, bucket).orderBy(*order)
    return (df.withColumn("_i", F.row_number().over(within).cast("long") - 1)
            .join(starts, F.col(group).eqNullSafe(F.col("_own_group")) & F.col(bucket).eqNullSafe(F.col("_own_part")))
            .withColumn(out, F.col("_start") + F.col("_i"))
            .drop("_own_group", "_own_part", "_start", "_i"))
