"""What no plan of the workload may hold."""

import re

import pytest

from dayferry.workload.queries import QUERIES

FORBIDDEN = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups"
    r"|Scan ExistingRDD|\bWindow \["
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.findall(plan)
