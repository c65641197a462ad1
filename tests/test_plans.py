"""Plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from conftest import DATA
from riskweave.operators import detectors, hybrid, retrieval
from riskweave.plans.tables import Tables
from riskweave.session import shared_root


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = physical(entry.queries()["J9_regression_metrics"](spark, DATA))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan
    t = Tables(spark, DATA)
    plan = physical(t.customers.where("risk_level = 'HIGH'").select("customer_id"))
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["C2_velocity_alerts", "C5_geographic_alerts", "C6_fraud_report", "D1_velocity_tier", "D2_amount_deviation", "D4_history_score", "H4_moving_average", "E1_rule_score"])
def test_rows_are_never_ordered_per_whole_customer(spark, name):
    """Windows over rows also partition by a slice; only slice summaries are ordered per key."""
    plan = physical(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in re.findall(r"Window \[.*", plan):
        over_rows = re.search(r"(row_number|rangeframe|RangeFrame)", line)
        if over_rows and "Limit" not in line:
            lists = line.split("], [")
            if lists[-1].startswith("_slice"):
                continue  # one summary row per slice
            partition = lists[-2]
            assert "_slice" in partition or "second" in partition or "_block" in partition, line


def test_newest_rows_are_limited_before_the_shuffle(spark):
    plan = physical(hybrid.newest(Tables(spark, DATA).tx, 5))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_no_python_in_the_fraud_report(spark):
    plan = physical(detectors.fraud_report(Tables(spark, DATA).tx))
    assert "Python" not in plan and "Pandas" not in plan


def test_search_leaves_its_query_table_to_spark(spark, monkeypatch):
    """The plan is built without reading a row and has one scan a side, whatever the number of blocks."""
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "i int, v array<double>")
    for name in ("collect", "toLocalIterator", "toPandas", "first"):
        monkeypatch.setattr(type(vectors), name, lambda *a, **b: pytest.fail("read while planning"))
    near = retrieval.dense_search(vectors, "i", "v", vectors.withColumnsRenamed({"i": "q", "v": "qv"}), "q", "qv", k=3, block=2)
    assert physical(near).count("Scan ExistingRDD") == 2
    monkeypatch.undo()
    assert near.count() == 150


def test_scratch_follows_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
