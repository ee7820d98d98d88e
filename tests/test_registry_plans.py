"""Plan invariants of every registered (non-stream) query."""

import pytest

from conftest import SF_SMALL
from helpers import plan_text

from tidemark.registry import QUERIES

NAMES = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_text(QUERIES[n](spark, SF_SMALL), "simple") for n in NAMES}


def test_no_python_and_no_cross_product(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p, name


def test_nested_loop_join_only_against_the_fixed_size_table(plans):
    loops = [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p]
    assert loops == ["sql_join_range"]
    assert "nation.parquet" in plans["sql_join_range"]


def test_latest_per_key_aggregates_map_side(plans):
    p = plans["sql_latest_per_key"]
    assert "partial_max_by" in p
    assert "Window" not in p
