"""Plan checks: the SQL-checkable queries stay JVM-side and never pair rows blindly."""

import pytest

from churnkit.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "PythonUDF"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    """No Python and no pairing of rows; what one partition gathers is an aggregate's result, not table rows."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name} uses {node}"
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1:] if not any(n in x for n in ("Project", "Filter", "Sort")))
            assert "Aggregate" in below, (name, below)
