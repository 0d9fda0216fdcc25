"""Table sinks: full refresh (K1), create-as-select (K2), insert-or-ignore
(K3), bulk load (K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.dedup import first_per_key
from ..operators.joins import MAX_PROBE_BYTES, anti_join, key_bytes
from ..sources.paths import path_exists
from ..sources.tables import conform
from . import copy_text, snapshot


def _writer(df: DataFrame, mode: str, fmt: str = "parquet", partition_by=None):
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_full_refresh(df: DataFrame, path: str | None = None, table: str | None = None,
                       schema: T.StructType | None = None, fmt: str = "parquet") -> None:
    """K1: replace the contents, keeping a fixed target schema. Idempotent.

    Writing to a catalog table replaces it in one commit on table formats that
    support it; a plain path overwrite is not atomic for concurrent readers
    (``refresh_atomic`` is)."""
    out = conform(df, schema) if schema is not None else df
    w = _writer(out, "overwrite", fmt)
    if table:
        w.saveAsTable(table)
    else:
        w.save(path)


def refresh_atomic(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """K1 and K2 by path for readers that may come at any time: the new contents
    are a new snapshot version (``sinks.snapshot``), and ``read_refreshed`` gives
    the last whole one. With a schema the rows are conformed to it (K1);
    without, it follows the query (K2)."""
    snapshot.write_snapshot(conform(df, schema) if schema is not None else df, path)


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The contents that ``refresh_atomic`` last stored whole."""
    version = snapshot.latest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing has been stored at {path}")
    return spark.read.parquet(snapshot.version_path(path, version))


def write_ctas(df: DataFrame, path: str | None = None, table: str | None = None,
               fmt: str = "parquet") -> None:
    """K2: drop + create-table-as-select; the schema follows the query."""
    write_full_refresh(df, path=path, table=table, schema=None, fmt=fmt)


def rows_to_insert(new: DataFrame, existing: DataFrame, keys: list[str],
                   order_by: list[str], small: bool = False) -> DataFrame:
    """K3 (batch): INSERT ... ON CONFLICT (keys) DO NOTHING.

    Among new rows the first by ``order_by`` wins per key (D2); a key already
    in ``existing`` wins over any new row (J3). Null keys are dropped, since a
    NOT NULL unique key rejects them. ``small``: see ``operators.joins.anti_join``
    (probe a huge target without shuffling it)."""
    cand = new.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return anti_join(first_per_key(cand, keys, order_by), existing, keys, small)


def insert_ignore(new: DataFrame, target_path: str, keys: list[str],
                  order_by: list[str], fmt: str = "parquet",
                  max_probe_bytes: int = MAX_PROBE_BYTES) -> DataFrame:
    """K3 against a stored table: append only new keys and return them.

    Only a missing path counts as an empty target; a read that fails is raised.
    With one writer a retried batch adds nothing the second time (the
    anti-join sees the first attempt's rows)."""
    spark = new.sparkSession
    if path_exists(spark, target_path):
        existing = spark.read.schema(new.schema).format(fmt).load(target_path)
        small = key_bytes(new, keys) <= max_probe_bytes
        add = rows_to_insert(new, existing, keys, order_by, small)
    else:
        add = first_per_key(new.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)), keys, order_by)
    add = add.select(*new.columns)
    add.write.mode("append").format(fmt).save(target_path)
    return add


def bulk_load(df: DataFrame, path: str, fmt: str = "parquet", tsv: bool = False) -> None:
    """K4: append rows in parallel (one file per task). ``tsv`` writes the
    tab-separated text of database bulk loaders (``copy_text``)."""
    if tsv:
        copy_text.write_copy(df, path)
    else:
        df.write.mode("append").format(fmt).save(path)
