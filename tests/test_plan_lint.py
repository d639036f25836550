"""Plan lint over every query of the reference's operators (sf0.001): no cartesian products,
no nested-loop joins, no Python. There are no explicit broadcast hints: all
broadcasts are Spark's own size-checked choices."""

import pathlib
import re

import pytest

from helpers import SF_SMALL
from idloom.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow", "Pandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_lint(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_no_broadcast_hints():
    root = pathlib.Path(__file__).resolve().parent.parent / "idloom"
    assert not [str(p) for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts
                and re.search(r"F\.broadcast\(|\.hint\(", p.read_text())]
