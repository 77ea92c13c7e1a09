"""Plan audit over the registered queries: no step gathers raw rows in one task.

A ``SinglePartition`` exchange is allowed only directly above an aggregate
(partial rows, one per map task, or already-final groups); Cartesian
products, nested-loop joins and global top-k / limits over data are not.
"""

import re

import pytest

from locations import SF_SMALL
from postlake.plans.catalog import QUERIES

# these train models or run whole jobs while the query is built (their result is a
# small report beside them); their plans are checked through the operators they call
SKIP = {"train_predict", "self_train_best"}
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|TakeOrderedAndProject|CollectLimit|GlobalLimit")


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k not in SKIP))
def test_no_single_task_step(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [l for l in lines if FORBIDDEN.search(l)]
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            assert "Aggregate" in below, f"{name}: {line.strip()} <- {below.strip()}"
