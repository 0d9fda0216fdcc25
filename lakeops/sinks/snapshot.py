"""K5: snapshot write with atomic replace for readers.

Each snapshot is a new version directory ``base/v=<20-digit number>``. Spark's
job commit writes ``_SUCCESS`` last, and readers only pick the highest version
that has it, so a reader never sees half a snapshot. Older versions beyond
``keep`` are removed after a new one commits (one old version stays for
readers still scanning it). Versions chosen from a stream's batch id make a
retried batch overwrite its own version only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PREFIX = "v="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(_PREFIX):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                try:
                    out.append(int(name[len(_PREFIX):]))
                except ValueError:
                    pass
    return sorted(out)


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{_PREFIX}{int(version):020d}"


def latest_version(spark: SparkSession, base: str, below: int | None = None) -> int | None:
    vs = [v for v in committed_versions(spark, base) if below is None or v < below]
    return vs[-1] if vs else None


def write_snapshot(df: DataFrame, base: str, version: int | None = None,
                   keep: int = 2) -> int:
    """Write ``df`` as a new committed version and return its number."""
    spark = df.sparkSession
    if version is None:
        last = latest_version(spark, base)
        version = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(version_path(base, version))
    _prune(spark, base, keep)
    return version


def _prune(spark: SparkSession, base: str, keep: int) -> None:
    vs = committed_versions(spark, base)
    fs, _, jvm = _fs(spark, base)
    for v in vs[:-keep] if keep > 0 else []:
        fs.delete(jvm.org.apache.hadoop.fs.Path(version_path(base, v)), True)


def read_snapshot(spark: SparkSession, base: str, schema: T.StructType | str,
                  version: int | None = None) -> DataFrame:
    """The current (or a given) committed snapshot; empty if none."""
    v = latest_version(spark, base) if version is None else version
    if v is None:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(version_path(base, v))
