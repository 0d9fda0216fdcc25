"""Distinct and first-record-per-key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key in ``order_by`` order (ties: any).

    ``min_by(struct(row), struct(order))`` is a partial aggregate: each task
    keeps one row per key before the shuffle, so a key holding a third of the
    input costs one row per task, not a third of the data in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = F.struct(*[F.col(c) for c in order_by])
    row = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.min_by(row, order).alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]))


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SELECT DISTINCT (partial aggregate on every column)."""
    return (df.select(*columns) if columns else df).distinct()
