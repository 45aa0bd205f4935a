"""Plan shapes: what must hold for every registered query, whatever the data size."""

import re

import pytest

from catalog import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Joins planned as for sides too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_plan(no_broadcast, name):
    df = all_queries.QUERIES[name](no_broadcast, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    # Only the list of hot keys, bounded by definition, may be broadcast.
    for line in re.findall(r"BroadcastHashJoin .*", plan):
        assert "_hot#" in line, line
    assert not re.search(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups)", plan)
    for window in re.findall(r"Window \[.*?\], \[(.*?)\]", plan):
        assert window.strip(), "a window without partitioning runs in one task"


def test_queries_and_oracles_cover_each_other():
    without = set(all_queries.QUERIES) - set(all_queries.ORACLES)
    assert without == set()
    assert not set(all_queries.ORACLES) - set(all_queries.QUERIES)
