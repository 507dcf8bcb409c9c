"""Plan-shape guards: no registered query may fall back to a cross join,
a nested-loop join, or Python execution, and the key scale properties of
docs/PLANS.md stay in the plans."""
import pytest

from verity.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that first run the batch job several times: their operators' plans
# are asserted where these are tested (test_release.py, test_stored.py).
SEVERAL_RUNS = ("merge", "released", "rollup", "run_difference_by_day", "rerun_proof", "merged_readback")


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(q(spark, SF)) for k, q in QUERIES.items() if not k.startswith(SEVERAL_RUNS)}


def test_no_cross_joins_or_python_in_any_query(plans):
    bad = {k: [f for f in FORBIDDEN if f in p] for k, p in plans.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_dedupe_limits_rows_before_the_shuffle(plans):
    p = plans["dedupe"]
    assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p


def test_orphans_aggregate_below_a_left_join(plans):
    p = plans["orphans"]
    assert "LeftAnti" not in p and "LeftOuter" in p
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "LeftOuter" in line)
    assert any("HashAggregate(keys=[key" in line for line in lines[join + 1:])


def test_top_customers_aggregates_before_the_join(plans):
    lines = plans["top_customers"].splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "Inner" in line)
    assert any("partial_sum(amount" in line for line in lines[join + 1:])
