"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from convlens.plans.catalog import REGISTRY
from convlens.plans.oracle import ORACLE
from tests.compare import differences, duck

# Trees and streams start many jobs; two of each stand for their family here, and
# ``python tests/compare.py`` covers all.
SLOW = {"feature_importance", "stream_dedupe", "stream_realtime_cr"}


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("key", [k for k in ORACLE if k not in SLOW])
def test_query_agrees(spark, sf, connection, key):
    frame = entry.queries()[key](spark, sf)
    assert differences(frame, connection.sql(entry.oracle_sql()[key])) == []


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_plans_stay_distributed(spark, sf):
    """No query needs a cross join, a nested loop or Python workers."""
    skipped = {"segment_tree", "segment_rules", "feature_importance", "tree_cv_accuracy"}
    for key, query in REGISTRY.items():
        if key in skipped or key.startswith("stream_"):
            continue
        plan = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval"):
            assert word not in plan, f"{word} in {key}"


def test_time_bound_reaches_the_scan(spark, sf):
    plan = entry.queries()["cr_by_segment"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2023-12-31T22:00)" in plan
    assert "user_id" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_dedupe_prunes_in_the_map_tasks(spark, sf):
    plan = entry.queries()["dedupe_visits"](spark, sf)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
