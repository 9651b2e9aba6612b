"""What no plan of a registered query may contain, and what the central ones must."""

import re

import pytest

import __spark_entry__ as contract
from conftest import TESTDATA
from thornwall.operators import conform, detect, triage
from thornwall.plans import queries, workspace

SF = str(TESTDATA / "sf0.001")
# What may reach a single task: counters, a row per task or bucket; and the windows of
# runs in the derived data, at most one row per calendar day.
BOUNDED = {"base_layout", "dq_expectation_metrics", "landing_totals", "window_gaps", "window_gaps_across_runs", "gold_published"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_no_plan_gathers_multiplies_or_leaves_the_jvm(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan
    if name not in BOUNDED:
        assert "SinglePartition" not in plan
    elif "SinglePartition" in plan:
        assert "partial_" in plan


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_every_count_is_reduced_before_its_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    aggregates = re.findall(r"(?:Hash|Sort|ObjectHash)Aggregate\(.*", plan)
    assert not aggregates or any("partial_" in a for a in aggregates) or "functions=[]" in plan


def scanned(plan):
    return re.findall(r"ReadSchema: struct<([^\n]*)", plan)


def test_reports_read_few_columns(spark):
    cves = workspace.upserted(spark, SF).table("cves")
    plan = plan_of(contract.queries()["cve_cwe_top"](spark, SF))
    assert scanned(plan) == ["cwe_ids:array<string>>"]
    assert "PushedFilters: [IsNotNull(modified_at)" in plan_of(cves.where("modified_at > timestamp'2024-01-02'"))
    rules = plan_of(contract.queries()["alert_volume"](spark, SF))
    assert "event_id" not in rules and rules.count("FileScan") == 1


def test_sorted_report_scans_once(spark):
    plan = plan_of(contract.queries()["cve_recent_critical"](spark, SF))
    assert plan.index("rangepartitioning") < plan.index("REBALANCE_PARTITIONS") < plan.index("FileScan")


def test_triage_is_the_same_without_broadcast(spark):
    source = queries._cve_source()

    def result():
        context = triage.cve_context(workspace.upserted(spark, SF).table("cves"))
        events = workspace.events(spark, SF).withColumns(conform.event_columns())
        alerts = detect.alerts(events, detect.EVENT_RULES, "events", "asset", "ts")
        df = triage.triage(alerts, context, source, detect.EVENT_RULES)
        return sorted(str(r) for r in df.collect()), plan_of(df)

    small = result()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        large = result()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in large[1] and small[0] == large[0]
