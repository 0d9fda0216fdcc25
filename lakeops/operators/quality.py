"""Table audit for the constraints the source DDL declares (Q1-Q4).

Every check returns rows ``(table_name, rule, column_name, violations)``.
NOT NULL and VARCHAR(n) are one pass with ``count_if`` per column; UNIQUE
is a grouped count (partial aggregate, so a hot key costs one row per task);
FOREIGN KEY is written as a count per key value anti-joined with the parent
keys. Catalyst is free to push the anti join below the count (it does when
the parent side broadcasts: a shuffle-free streaming anti join); as a
sort-merge anti join a hot key on the child side is split by AQE's skew
handling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = ["table_name", "rule", "column_name", "violations"]


def _rows(df: DataFrame, table: str, rule: str, counts: dict) -> DataFrame:
    agg = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    # one row of counts becomes a row per rule: a union of selections would be
    # pruned into a scan per column
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                              F.lit(name).alias("column_name"),
                              F.col(f"_{i}").cast("bigint").alias("violations"))
                     for i, name in enumerate(counts)])
    return agg.select(F.inline(rows))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q1: rows with NULL in a NOT NULL column."""
    return _rows(df, table, "not_null", {c: F.count_if(F.col(c).isNull()) for c in columns})


def max_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Q4: values longer than VARCHAR(n) (characters)."""
    return _rows(df, table, "max_length",
                 {c: F.count_if(F.length(F.col(c)) > n) for c, n in limits.items()})


def unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Q2: rows whose key is shared with another row. NULL keys never
    violate UNIQUE (SQL semantics)."""
    non_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = (df.where(non_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1))
    return dup.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"),
        F.lit(",".join(keys)).alias("column_name"), "violations")


def foreign_key(child: DataFrame, table: str, cols: list[str], parent: DataFrame,
                parent_cols: list[str]) -> DataFrame:
    """Q3: child rows whose (non-NULL) key has no parent row."""
    non_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    per_value = child.where(non_null).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, cols)])
    orphans = per_value.join(keys, cols, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("foreign_key").alias("rule"),
        F.lit(",".join(cols)).alias("column_name"), "violations")


def audit(tables: dict[str, DataFrame], not_null_cols: dict | None = None,
          unique_keys: dict | None = None, foreign_keys: list | None = None,
          lengths: dict | None = None) -> DataFrame:
    """All checks over a set of tables (defaults: the star-schema DDL)."""
    from .. import schemas
    nn = schemas.NOT_NULL if not_null_cols is None else not_null_cols
    uq = schemas.UNIQUE if unique_keys is None else unique_keys
    fk = schemas.FOREIGN_KEYS if foreign_keys is None else foreign_keys
    ln = schemas.MAX_LENGTH if lengths is None else lengths
    parts = []
    for t, cols in nn.items():
        if t in tables:
            parts.append(not_null(tables[t], t, [c for c in cols if c in tables[t].columns]))
    for t, key_sets in uq.items():
        if t in tables:
            parts += [unique(tables[t], t, ks) for ks in key_sets
                      if all(k in tables[t].columns for k in ks)]
    for child, cols, parent, pcols in fk:
        if child in tables and parent in tables:
            parts.append(foreign_key(tables[child], child, cols, tables[parent], pcols))
    for t, limits in ln.items():
        if t in tables:
            parts.append(max_length(tables[t], t, {c: n for c, n in limits.items()
                                                   if c in tables[t].columns}))
    return reduce(DataFrame.unionByName, parts)
