"""Plan-shape checks: the properties that matter at scale, asserted on the physical plans."""

import re

import pytest

from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as entry

    return entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def plans(spark, registry):
    # a grid's result is the scan of its results table, whatever its points did
    q, sql = registry
    return {name: _plan(q[name](spark, SF001)) for name in sorted(sql) if not name.startswith("tune_")}


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = {name: [f for f in FORBIDDEN if f in plan] for name, plan in plans.items()}
    assert {name: hits for name, hits in bad.items() if hits} == {}


def test_single_tasks_get_partial_aggregates_only(plans):
    # whatever meets in one task has been reduced to a row per partition before
    bad = set()
    for name, plan in plans.items():
        lines = plan.split("\n")
        for above, below in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in above and "partial" not in below:
                bad.add((name, below.strip()))
    assert bad == set()


def test_topk_is_limited_before_the_shuffle(registry, plans):
    assert re.search(r"WindowGroupLimit .*Partial", plans["topk_actual"])
    assert re.search(r"WindowGroupLimit .*Final", plans["topk_actual"])


@pytest.mark.parametrize("name", ["candidates_dot", "knn_unseen_topk", "candidates_dot_p"])
def test_retrieval_lists_leave_their_task_complete(plans, name):
    # neither a window nor a shuffle follows the block scorer
    above = plans[name].split("MapInArrow")[0]
    assert "MapInArrow" in plans[name] and "Exchange" not in above and "Window" not in plans[name]


def test_scans_read_only_needed_columns(spark, registry):
    plan = _plan(registry[0]["src_interactions"](spark, SF001))
    scans = [l for l in plan.split("\n") if "FileScan parquet" in l]
    cols = sorted(c.split("#")[0] for s in scans for c in re.search(r"FileScan parquet \[([^\]]*)\]", s).group(1).split(","))
    assert cols == sorted(["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate", "o_orderkey", "o_custkey"])


def test_split_is_read_back_with_pushed_filter(spark, registry):
    plan = _plan(registry[0]["split_test"](spark, SF001))
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l]
    assert len(scan) == 1 and "is_test" in scan[0] and "PushedFilters: [IsNotNull(is_test), EqualTo(is_test,true)]" in scan[0]


@pytest.mark.parametrize("name", ["candidates_als", "knn_als", "knn_lsh", "als_predict_pairs"])
def test_model_retrieval_plans_have_no_cartesian(spark, registry, name):
    plan = _plan(registry[0][name](spark, SF001))
    assert not [f for f in FORBIDDEN if f in plan]
