"""Table reads.

Every reader returns a lazy DataFrame; column lists are explicit so the
parquet scan reads only what the job uses, and filters written later are
pushed into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, location: str, name: str | None = None,
               columns: list[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read ``location/name.parquet`` (or a catalog table when ``location`` is
    ``None``). ``schema`` casts to a declared StructType (fixed-schema tables)."""
    if location is None:
        df = spark.table(name)
    else:
        path = f"{location.rstrip('/')}/{name}.parquet" if name else location
        df = spark.read.parquet(path)
    if schema is not None:
        df = conform(df, schema)
    if columns:
        df = df.select(*columns)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a declared schema. Columns absent from the input
    become NULL (a DDL default is applied by the caller)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str],
              properties: dict | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """S1 for a live database: explicit column list, optional range split so a
    large table is read by many tasks instead of one connection."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions or 8))
    return reader.load().select(*columns)


STAR_TABLES = ("dim_customers", "dim_products", "dim_orders", "fact_order_items",
               "fact_shipments")


def read_star(spark: SparkSession, location: str | None = None,
              fmt: str = "parquet") -> dict[str, DataFrame]:
    """The five star-schema tables, cast to their declared schemas, from
    ``location/<table>`` (or from the catalog when ``location`` is None).
    CHAR(n) padding, if the source kept it, is trimmed from ``country``."""
    from .. import schemas
    out = {}
    for name in STAR_TABLES:
        if location is None:
            df = spark.table(name)
        else:
            df = spark.read.format(fmt).load(f"{location.rstrip('/')}/{name}")
        df = conform(df, schemas.STAR[name])
        if name == "dim_customers":
            df = df.withColumn("country", F.rtrim("country"))
        out[name] = df
    return out
