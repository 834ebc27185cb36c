"""Every named query: same rows as its SQL, and a plan without cross joins or Python."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import check  # noqa: E402

from lapsewatch import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonMapInArrow"]
SLOW = {n for n, ops in catalog.operators().items() if any(o[0] == "T" and o not in ("T5", "T9", "T10") for o in ops)}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_query(spark, con, name):
    q, sql = catalog.queries()[name], catalog.oracle_sql().get(name)
    ok, note = check.compare(spark, con, SF, name, q, sql)
    assert ok, note


@pytest.mark.parametrize("name", ["feature_store", "inference_features", "churn_labels_long", "latest_transaction", "iqr_clean",
                                  "monitoring_report", "roc_auc_by_side", "stratified_split", "bronze_merge", "member_snapshot",
                                  "quantile_profile_lines", "distribution", "class_weights", "split_windows"])
def test_plan(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [u for u in UNWANTED if u in plan]


def test_top1_prunes_before_the_shuffle(spark):
    plan = catalog.queries()["latest_transaction"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


def test_partition_filter_reaches_the_scan(spark):
    plan = catalog.queries()["partition_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_names_agree():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
