"""Plan shape of every registered query: no nested-loop or Cartesian joins,
no unpartitioned window over data that grows, projections reach the scan."""

import re

import pytest

import __spark_entry__ as E
from scorewatch.plans.catalog import QUERIES

from conftest import SF_SMALL

# The dense id's offset window runs over one row per sampled range (bounded).
UNPARTITIONED_WINDOW_OK = {"movement_surrogate_id", "stg_card_movements", "dq_report", "dq_not_null",
                           "dq_unique"}


def _first_arg(text: str) -> str:
    depth = 0
    for i, ch in enumerate(text):
        if ch == "(":
            depth += 1
        elif ch == ")":
            if depth == 0:
                return text[:i]
            depth -= 1
        elif ch == "," and depth == 0:
            return text[:i]
    return text


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    for line in plan.splitlines():
        for m in re.finditer(r"windowspecdefinition\(", line):
            first = _first_arg(line[m.end():])
            if " ASC " in f"{first} " or " DESC " in f"{first} ":
                # The spec starts with a sort order: no PARTITION BY.
                assert name in UNPARTITIONED_WINDOW_OK and first.startswith("_first"), line


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["fct_fraud_alerts"](spark, SF_SMALL))
    events_scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan) or re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert events_scans and all("props" not in s for s in events_scans)
