"""The query registry: name -> (spark, sf_dir) -> DataFrame, and the
DuckDB oracle SQL for each name that has one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ...session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a write-path query, under the session's
    shared checkpoint folder."""
    return shared_path(spark, "lakeops-runs", f"{name}-{uuid.uuid4().hex}")
