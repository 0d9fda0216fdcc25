"""Q1-Q4 table audit over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import quality
from ...sources import testdata as td
from .base import register


# --------------------------------------------------------------------------
# Q1-Q4 table audit over the supplied tables
# --------------------------------------------------------------------------


@register("quality_not_null", """
SELECT 'lineitem' AS table_name, 'not_null' AS rule, c AS column_name, v AS violations FROM (
  SELECT 'l_orderkey' AS c, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS v FROM lineitem
  UNION ALL SELECT 'l_partkey', COUNT(*) FILTER (WHERE l_partkey IS NULL) FROM lineitem
  UNION ALL SELECT 'l_quantity', COUNT(*) FILTER (WHERE l_quantity IS NULL) FROM lineitem)
UNION ALL
SELECT 'orders', 'not_null', c, v FROM (
  SELECT 'o_orderkey' AS c, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS v FROM orders
  UNION ALL SELECT 'o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders)
""")
def q_quality_not_null(spark, d):
    return quality.not_null(td.table(spark, d, "lineitem"), "lineitem",
                            ["l_orderkey", "l_partkey", "l_quantity"]).unionByName(
        quality.not_null(td.table(spark, d, "orders"), "orders", ["o_orderkey", "o_custkey"]))


@register("quality_unique", """
SELECT 'lineitem' AS table_name, 'unique' AS rule, 'l_orderkey,l_linenumber' AS column_name,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS violations
FROM (SELECT COUNT(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) a
UNION ALL
SELECT 'orders', 'unique', 'o_orderkey', CAST(COALESCE(SUM(n), 0) AS BIGINT)
FROM (SELECT COUNT(*) AS n FROM orders WHERE o_orderkey IS NOT NULL
      GROUP BY o_orderkey HAVING COUNT(*) > 1) b
UNION ALL
SELECT 'part', 'unique', 'p_name', CAST(COALESCE(SUM(n), 0) AS BIGINT)
FROM (SELECT COUNT(*) AS n FROM part WHERE p_name IS NOT NULL
      GROUP BY p_name HAVING COUNT(*) > 1) c
""")
def q_quality_unique(spark, d):
    return (quality.unique(td.table(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
            .unionByName(quality.unique(td.table(spark, d, "orders"), "orders", ["o_orderkey"]))
            .unionByName(quality.unique(td.table(spark, d, "part"), "part", ["p_name"])))


_FK_SQL = """
SELECT '{ct}' AS table_name, 'foreign_key' AS rule, '{cc}' AS column_name,
       CAST(COUNT(*) AS BIGINT) AS violations
FROM {ct} c WHERE c.{cc} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = c.{cc})
"""
_FKS = [("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey")]


@register("quality_foreign_key", "\nUNION ALL\n".join(
    _FK_SQL.format(ct=ct, cc=cc, pt=pt, pc=pc) for ct, cc, pt, pc in _FKS))
def q_quality_foreign_key(spark, d):
    parts = [quality.foreign_key(td.table(spark, d, ct), ct, [cc], td.table(spark, d, pt), [pc])
             for ct, cc, pt, pc in _FKS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_LEN_LIMITS = {"customer": {"c_name": 18, "c_mktsegment": 9}, "part": {"p_name": 10, "p_type": 8}}


@register("quality_length", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'max_length' AS rule, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {t}"
    for t, lim in _LEN_LIMITS.items() for c, n in lim.items()))
def q_quality_length(spark, d):
    return quality.max_length(td.table(spark, d, "customer"), "customer", _LEN_LIMITS["customer"]) \
        .unionByName(quality.max_length(td.table(spark, d, "part"), "part", _LEN_LIMITS["part"]))


# --------------------------------------------------------------------------
# The same rules where the answers are not zero: NULLs made by nullif, and
# orders that no line refers to
# --------------------------------------------------------------------------


@register("quality_not_null_derived", """
SELECT 'lineitem' AS table_name, 'not_null' AS rule, c AS column_name, v AS violations FROM (
  SELECT 'l_orderkey' AS c, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS v FROM lineitem
  UNION ALL SELECT 'l_quantity', COUNT(*) FILTER (WHERE nullif(l_quantity, 7) IS NULL) FROM lineitem
  UNION ALL SELECT 'l_returnflag', COUNT(*) FILTER (WHERE nullif(l_returnflag, 'R') IS NULL) FROM lineitem)
""")
def q_quality_not_null_derived(spark, d):
    items = td.table(spark, d, "lineitem").select(
        "l_orderkey", F.nullif("l_quantity", F.lit(7)).alias("l_quantity"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"))
    return quality.not_null(items, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])


@register("quality_orders_without_lines", _FK_SQL.format(ct="orders", cc="o_orderkey", pt="lineitem", pc="l_orderkey"))
def q_quality_orders_without_lines(spark, d):
    return quality.foreign_key(td.table(spark, d, "orders"), "orders", ["o_orderkey"],
                               td.table(spark, d, "lineitem"), ["l_orderkey"])
