"""Plan guards for every registered query: no Python
evaluation, no Cartesian product or nested-loop join, Parquet scans read
only the columns they need."""

from __future__ import annotations

import re

import pytest

from aerolith.plans.registry import QUERIES, STAGED

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_or_cartesian_nodes(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_lineitem_scan_is_pruned(spark):
    df = QUERIES["gold_route_performance"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_extendedprice" not in s and "l_shipdate" not in s for s in lineitem)


def test_queries_are_independent_of_the_callers_time_zone(spark):
    names = ["gold_passenger_communication", "notification_coverage", "weather_first_observation"]
    expected = {n: sorted(map(tuple, QUERIES[n](spark, "/root/testdata/sf0.001").collect()), key=repr) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for n in names:
            got = sorted(map(tuple, QUERIES[n](spark, "/root/testdata/sf0.001").collect()), key=repr)
            assert got == expected[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_building_a_query_starts_no_job(spark):
    """Only schemas are read: a query computes nothing before its result is
    asked for, unless it says that it writes a table first."""
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    sc.setJobGroup("building", "building registered queries")
    try:
        for name, query in QUERIES.items():
            if name not in STAGED:
                query(spark, "/root/testdata/sf0.001")
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("building")]
        names = {tracker.getStageInfo(s).name.split(" at ")[0] for job in jobs for s in job.stageIds}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert names <= {"parquet"}  # footers
