"""With automatic broadcasts off (what large sides get at scale), the
join-heavy queries run as sort-merge joins and still match their oracles."""

import pytest

import __spark_entry__ as E
from tests.test_registry import SF, _digest, con  # noqa: F401

JOINY = ["top_products", "orders_by_country", "validate", "validate_swept", "insert_ignore",
         "quality_foreign_key", "ticket_lookup", "first_wins"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", JOINY)
def test_sort_merge_path_matches_oracle(no_broadcast, con, name):  # noqa: F811
    spark = no_broadcast
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in ("top_products", "orders_by_country", "validate", "insert_ignore"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert _digest(df.columns, rows) == _digest(ocols, cur.fetchall())
