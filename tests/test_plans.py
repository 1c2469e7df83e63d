"""Plan guards: no all-pairs joins, pruned scans, partial aggregation."""

import re

import pytest

import __spark_entry__ as entry_mod

from .conftest import SF_SMALL

# Queries whose construction has no side effects (no writes, no streams).
PURE_PREFIXES = ("dim_", "fact_", "standings_", "event_", "historical_", "silver_", "rule_", "dq_", "feat_", "trend_",
                 "profile_", "session_")


def _pure():
    return sorted(n for n in entry_mod.queries() if n.startswith(PURE_PREFIXES) and n != "dq_failure_examples")


@pytest.mark.parametrize("name", _pure())
def test_no_all_pairs_and_pruned_scans(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert len(re.findall(r"[^,<>]+:[^,<>]+", schema)) <= 12, schema


def test_grouped_aggregates_are_partial(spark):
    df = entry_mod.queries()["fact_results"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan


def test_one_season_prunes_the_others(spark):
    df = entry_mod.queries()["master_one_season"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1997", plan)
