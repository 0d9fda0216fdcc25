"""Regression guards for the plan shapes the scale design relies on."""

import json
import os

import __spark_entry__ as E
from lakeops.plans import tickets
from lakeops.sources.jsonlog import read_log

SF = "/root/testdata/sf0.001"


def executed(df):
    """The final adaptive plan (without AQE's copy of the initial plan)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_top_products_prunes_and_aggregates_before_the_shuffle(spark):
    plan = executed(E.queries()["top_products"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    # map-side partial sum of the fact table, then the exchange
    assert "partial_sum(quantity" in plan
    assert plan.index("partial_sum(quantity") > plan.index("Exchange hashpartitioning(product_id")
    assert "TakeOrderedAndProject" in plan


def test_silver_pushes_the_null_filter_into_the_scan(spark):
    plan = executed(E.queries()["silver_events"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type)]" in plan


def test_ordered_scans_read_written_segments(spark):
    """Segment numbers come from files, so no reader can disagree on them."""
    for name in ("validate", "validate_swept"):
        plan = executed(E.queries()[name](spark, SF))
        assert "rangepartitioning" not in plan and "lakeops-segments" in plan


def test_audit_of_one_table_is_one_scan(spark):
    from lakeops.operators import quality
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    cols = ["l_orderkey", "l_partkey", "l_quantity"]
    assert executed(quality.not_null(items, "lineitem", cols)).count("FileScan parquet") <= 1
    limits = {"l_returnflag": 1, "l_linestatus": 1}
    assert executed(quality.max_length(items, "lineitem", limits)).count("FileScan parquet") <= 1


def test_replay_parses_each_line_once(spark, tmp):
    os.makedirs(tmp + "/log")
    with open(tmp + "/log/a.log", "w") as f:
        for i in range(20):
            f.write(json.dumps({"op": "CREATE", "ticket_id": f"t{i % 3}", "passenger_name": "x",
                                "lsn": {"batch": 1, "seq": i}}) + "\n")
    df = tickets.replay(read_log(spark, tmp + "/log", explicit_lsn=True))
    assert optimized(df).count("from_json(") == 1
    assert df.count() == 3


def test_insert_path_parses_each_message_at_most_once_per_side(spark):
    plan = optimized(E.queries()["insert_ignore"](spark, SF))
    assert plan.count("from_json(") <= 3


def test_report_scans_read_only_used_columns(spark):
    plan = executed(E.queries()["shipment_stats"](spark, SF))
    assert "ReadSchema: struct<l_tax:double,l_returnflag:string>" in plan
