"""Sorts, top-k and exact sampling (O1-O3)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import key_text
from ..session import shared_path


def top_k(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """O2: ``ORDER BY ... LIMIT n``. Planned as TakeOrderedAndProject: every
    task keeps its own n best rows, so only n x tasks rows reach the final
    merge. n = 0 gives no rows; a negative n is an error."""
    if n is None or int(n) < 0:
        raise ValueError(f"limit must be a non-negative integer, got {n!r}")
    return df.orderBy(*order).limit(int(n))


_BITS, _LEVELS = 15, 4          # of the 60 bits that rank a row
_EDGE_ROWS = 1 << 16


def _boundary(counts: dict[int, int], need: int) -> tuple[int | None, int]:
    """Smallest bucket where the running count reaches ``need``; returns it and
    the number of rows in strictly smaller buckets."""
    before = 0
    for b in sorted(counts):
        if before + counts[b] >= need:
            return b, before
        before += counts[b]
    return None, before


def sample_rank(keys: list[str], seed: int) -> Column:
    """60 bits of the SHA-256 of the row's keys and the seed, as a long."""
    digest = F.sha2(F.concat(key_text(*keys), F.lit(f"|{seed}")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample_exact(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """O3: a uniform sample of exactly ``n`` rows (``ORDER BY random() LIMIT n``).

    Rows are ranked by a seeded hash of their key (ties broken by the key), so
    the same rows come out for any partitioning and on task retry. Instead of
    one giant top-n (n may be a third of the table), the n-th hash is located
    with histograms over the hash's bits, 32,768 buckets a level. Rows below the
    boundary bucket are kept by a plain filter; of a bucket with at most 65,536
    rows the first ones are taken by a small top-k. A larger one is cut by the next
    15 bits, down to one hash: its rows repeat one key, are interchangeable,
    and are taken file by file from a written copy."""
    if n < 0:
        raise ValueError("sample size must be >= 0")
    hashed, h = df.withColumn("_sample_h", sample_rank(keys, seed)), F.col("_sample_h")
    if n == 0:
        return df.limit(0)
    inside, prefix, need = hashed, 0, n
    for level in range(1, _LEVELS + 1):
        shift = _BITS * (_LEVELS - level)
        top = F.shiftright(h, shift)
        counts = {r[0]: r[1] for r in inside.groupBy(top.alias("b")).count().collect()}
        b, before = _boundary(counts, need)
        if b is None:                                                # n >= rows: everything
            return df
        need, prefix = need - before, b
        inside = hashed.where(top == b)
        if counts[b] == need:
            return hashed.where(top <= prefix).drop("_sample_h")
        if counts[b] <= _EDGE_ROWS:
            edge = inside.orderBy(h, *[F.col(k) for k in keys]).limit(need)
            break
    else:
        edge = _some_rows(inside, need)
    return hashed.where(top < prefix).unionByName(edge).drop("_sample_h")


def _some_rows(df: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` of the rows, whichever: they are written, and every file
    gives as many of its first rows as are still needed (one count per file)."""
    spark = df.sparkSession
    path = shared_path(spark, "lakeops-sample", uuid.uuid4().hex)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    quotas, need = [], n
    for r in sorted(rows.groupBy("_file").count().collect()):
        quotas.append((r[0], min(need, r[1])))
        need -= quotas[-1][1]
    quota = spark.createDataFrame(quotas, "_file string, _quota bigint")
    return rows.join(quota, "_file").where("_index < _quota").select(*df.columns)
