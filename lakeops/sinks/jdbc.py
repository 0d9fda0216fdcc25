"""JDBC forms of the table sinks, for targets that live in a database.

Not exercised by the tests (no database is started here); they are thin on
purpose: Spark's JDBC writer does the work, one connection per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _writer(df: DataFrame, url: str, table: str, properties: dict | None,
            batch_size: int, num_partitions: int | None):
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)      # caps concurrent connections
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    return w


def full_refresh_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                      batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """K1 into a database table: TRUNCATE (the table and its declared schema
    stay) then batched INSERTs. Readers can see the empty table in between,
    as with any truncate-and-load."""
    (_writer(df, url, table, properties, batch_size, num_partitions)
     .option("truncate", "true").mode("overwrite").save())


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """K4/K3 append of already de-duplicated rows (run ``rows_to_insert``
    first: the anti join replaces ON CONFLICT DO NOTHING for one writer)."""
    _writer(df, url, table, properties, batch_size, num_partitions).mode("append").save()
