"""Plan checks: no cartesian product, no window without a
partition key, no Python UDF in any registered query's physical plan."""

import re

import pytest

from stratum.plans.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_shape(spark, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan, name
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"Window \[.*\], \[\], \[", line), f"unpartitioned window in {name}: {line}"
    assert df.count() >= 0
