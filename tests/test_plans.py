"""What the plans must look like at any scale."""

import re

import pytest

from ebbline.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    """As on large data, where no side is small enough."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_per_row(spark, no_broadcast, name):
    plan = _plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name", ["lifetime_count", "word_lifetime_count", "decay_running", "decay_running_short", "item_dedup_composite"]
)
def test_running_totals_scan_once(spark, no_broadcast, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["topk_candidates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>", plan)
    assert "604800" not in plan  # the other intervals are not computed
    plan = QUERIES["window_count_1h"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>", plan)


def test_totals_are_combined_before_the_shuffle(spark):
    for name in ("tokens_drop_empty", "decay_final_long", "key_families"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan.split("Exchange")[-1]


def test_groups_are_pruned_before_the_shuffle(spark):
    assert _plan(QUERIES["knn_candidates"](spark, SF)).count("WindowGroupLimit") == 2
