"""Match-event medallion ETL: source -> bronze -> silver -> gold (M1-M4).

``bronze``, ``silver`` and ``gold`` are pure DataFrame transforms; ``run``
writes the three layers (full refresh / create-as-select) and returns the
layer-count report. Time enters only through ``as_of`` (NULL timestamps
become this one value for the whole run, like NOW() in one statement).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import as_of_lit, ilike, null_default
from ..operators.dedup import distinct_rows
from ..sinks.tables import read_refreshed, refresh_atomic, write_full_refresh
from ..sources.tables import conform

# Gold metric names and their case-insensitive patterns.
GOLD_PATTERNS = {
    "total_goals": "%goal%",
    "total_fouls": "%foul%",
    "total_shots": "%shot%",
}

SOURCE_COLUMNS = ["event_id", "match_id", "team", "player", "event_type", "event_ts"]


def bronze(source: DataFrame) -> DataFrame:
    """M1: explicit column list, ``event_ts`` renamed to ``timestamp`` by
    position, cast to the bronze schema. Every source row is kept."""
    df = source.select(*SOURCE_COLUMNS).withColumnRenamed("event_ts", "timestamp")
    return conform(df, schemas.BRONZE)


def silver(bronze_df: DataFrame, as_of=None) -> DataFrame:
    """M2: drop rows without an event type, default a NULL timestamp to
    ``as_of``, then DISTINCT over (match_id, team, event_type, timestamp).
    Repeats by different players at one instant collapse to one row."""
    ts = null_default("timestamp", as_of_lit(as_of, ntz=True)).alias("timestamp")
    cleaned = (bronze_df.where(F.col("event_type").isNotNull())
               .select("match_id", "team", "event_type", ts))
    return distinct_rows(cleaned)


def gold(silver_df: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """M3: per team, COUNT(*) FILTER (WHERE event_type ILIKE pattern) for each
    metric. One event may count in several metrics; a NULL team is a group."""
    pats = patterns or GOLD_PATTERNS
    aggs = [F.count_if(ilike("event_type", p)).alias(name) for name, p in pats.items()]
    return silver_df.groupBy("team").agg(*aggs)


def layer_counts_frame(spark: SparkSession, bronze_rows: int, silver_rows: int,
                       gold_rows: int) -> DataFrame:
    """M4 from known counts (for example the observed counts of ``run``)."""
    return spark.createDataFrame(
        [("bronze", bronze_rows), ("silver", silver_rows), ("gold", gold_rows)],
        "layer string, row_count bigint")


def layer_counts(b: DataFrame, s: DataFrame, g: DataFrame) -> DataFrame:
    """M4 as one lazy DataFrame: three global counts by union."""
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("layer"), "row_count")
    return cnt(b, "bronze").unionByName(cnt(s, "silver")).unionByName(cnt(g, "gold"))


def read_layer(spark: SparkSession, target: str | None, layer: str, database: str | None = None) -> DataFrame:
    """A layer as ``run`` stored it."""
    if database:
        return spark.table(f"{database}.{layer}")
    return read_refreshed(spark, f"{target.rstrip('/')}/{layer}")


def _store(df: DataFrame, target: str | None, layer: str, database: str | None, schema=None) -> DataFrame:
    """Replace a layer and read it back: K1 with a schema, K2 without."""
    if database:
        write_full_refresh(df, table=f"{database}.{layer}", schema=schema)
    else:
        refresh_atomic(df, f"{target.rstrip('/')}/{layer}", schema)
    return read_layer(df.sparkSession, target, layer, database)


def run(source: DataFrame, target: str | None = None, as_of=None,
        patterns: dict[str, str] | None = None, database: str | None = None) -> DataFrame:
    """Run the three layers into ``target``/{bronze,silver,gold}, or into the
    tables of those names of a catalog ``database``, and return the layer-count
    report. By path each layer is replaced at once (``refresh_atomic``), so
    ``read_layer`` never meets an empty or half-written one; a catalog table is
    replaced as its format does it. The bronze count is the number of rows read,
    observed while writing (no second scan); silver and gold count their written
    tables."""
    if not (target or database):
        raise ValueError("a target path or a database is needed")
    obs = Observation("bronze")
    b = bronze(source).observe(obs, F.count(F.lit(1)).alias("rows"))
    b_stored = _store(b, target, "bronze", database, schemas.BRONZE)
    s_stored = _store(silver(b_stored, as_of), target, "silver", database, schemas.SILVER)
    g_stored = _store(gold(s_stored, patterns), target, "gold", database)
    return layer_counts_frame(source.sparkSession, obs.get["rows"], s_stored.count(), g_stored.count())
