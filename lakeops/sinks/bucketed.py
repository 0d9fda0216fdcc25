"""K5 for a large keyed state: a snapshot in buckets, with a manifest.

``base/data/<version>/bucket=<b>`` holds a bucket as some version wrote it, and
``base/_manifest/<version>`` lists which version of each bucket makes up the
snapshot. A new snapshot writes the buckets it changes and a manifest that
takes the others over; the manifest is written under a temporary name and renamed,
so a reader sees the old snapshot or the new one, whole. The number of buckets
is a property of the stored state (the manifest's first line). Manifests beyond
``keep`` are dropped with the bucket folders that no later one names. One
writer per base."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import path_exists
from .snapshot import _fs

BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _manifest_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/_manifest/{version:020d}"


def _bucket_path(base: str, bucket: int, version: int) -> str:
    return f"{base.rstrip('/')}/data/{version:020d}/{BUCKET}={bucket}"


def versions(spark: SparkSession, base: str) -> list[int]:
    fs, p, _ = _fs(spark, f"{base.rstrip('/')}/_manifest")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())


def manifest(spark: SparkSession, base: str, version: int) -> tuple[int, dict[int, int]]:
    """(number of buckets, {bucket: version}) of a snapshot; one line a bucket."""
    lines = [r.value for r in spark.read.text(_manifest_path(base, version)).collect()]
    entries = dict(tuple(map(int, x.split("\t"))) for x in lines if "\t" in x)
    return int(next(x for x in lines if x.startswith("buckets ")).split()[1]), entries


def current(spark: SparkSession, base: str, buckets: int) -> tuple[int, int, dict[int, int]]:
    """(version, number of buckets, entries) of the newest snapshot; version -1
    and the given number if there is none."""
    found = versions(spark, base)
    return (found[-1], *manifest(spark, base, found[-1])) if found else (-1, buckets, {})


def read(spark: SparkSession, base: str, schema: str, entries: dict[int, int], only=None) -> DataFrame:
    """The rows of a snapshot's buckets, or of those in ``only``."""
    paths = [_bucket_path(base, b, v) for b, v in sorted(entries.items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write(df: DataFrame, base: str, key: str, version: int, buckets: int, entries: dict[int, int],
          touched: list[int], keep: int = 2) -> dict[int, int]:
    """Publish ``version``: ``df`` is the new content of the ``touched`` buckets
    (all rows of each), the others stay as in ``entries``."""
    spark = df.sparkSession
    data = f"{base.rstrip('/')}/data/{version:020d}"
    (df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
     .write.mode("overwrite").partitionBy(BUCKET).parquet(data))
    new = {b: v for b, v in entries.items() if b not in set(touched)}
    new |= {b: version for b in touched if path_exists(spark, _bucket_path(base, b, version))}
    fs, final, jvm = _fs(spark, _manifest_path(base, version))
    temporary = jvm.org.apache.hadoop.fs.Path(f"{final.toString()}.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.writeBytes("\n".join([f"buckets {buckets}", *(f"{b}\t{v}" for b, v in sorted(new.items()))]) + "\n")
    out.close()
    if not fs.rename(temporary, final):
        raise RuntimeError(f"snapshot {version} of {base} is there already: more than one writer")
    _prune(spark, base, keep)
    return new


def _prune(spark: SparkSession, base: str, keep: int) -> None:
    found = versions(spark, base)
    fs, _, jvm = _fs(spark, base)
    named = {x for v in found[-keep:] for x in manifest(spark, base, v)[1].items()}
    for v in found[:-keep]:
        for b, at in set(manifest(spark, base, v)[1].items()) - named:
            fs.delete(jvm.org.apache.hadoop.fs.Path(_bucket_path(base, b, at)), True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(_manifest_path(base, v)), False)
