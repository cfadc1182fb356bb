"""Scale properties of every registered query's executed plan.

* A SinglePartition exchange only ever gathers aggregated rows or top-k rows:
  walking down from it, an aggregate or TakeOrderedAndProject comes before
  any table scan.
* No cartesian products or nested-loop joins.

The plans of intermediate tables, which run while a report is built, count too; and
each report is planned once with broadcasts as the planner likes and once without any.
"""

import re

import pytest

from tests.conftest import SF001

from riskloom import session
from riskloom.plans.registry import all_queries

NAMES = sorted(all_queries())


def _subtrees(lines, needle):
    for i, line in enumerate(lines):
        if needle in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt.strip(" :+-"))
            yield sub


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def eager(monkeypatch):
    """Plans of the intermediate tables written meanwhile."""
    plans, real = [], session.save_scratch

    def watch(df, name):
        plans.append(_plan_of(df))
        return real(df, name)

    monkeypatch.setattr(session, "save_scratch", watch)
    return plans


@pytest.mark.parametrize("threshold", ["10485760b", "-1"])
@pytest.mark.parametrize("name", NAMES)
def test_single_partition_only_over_reduced_rows(spark, name, threshold, eager):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = all_queries()[name](spark, SF001)
        df.write.format("noop").mode("overwrite").save()
        plans = [*eager, _plan_of(df)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        for sub in _subtrees(plan.split("\n"), "Exchange SinglePartition"):
            for op in sub:
                if re.match(r"(HashAggregate|SortAggregate|ObjectHashAggregate|TakeOrderedAndProject)", op):
                    break
                assert not re.match(r"(FileScan|Scan )", op), (name, sub[:6])


def test_eager_plans_are_seen(spark, eager):
    all_queries()["aml_structuring"](spark, SF001)
    assert len(eager) == 2
