"""The driver contract: entry(), queries() and oracle_sql() at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

# Rows-only by design (model output, feature importances).
NO_ORACLE = {"model_predicted_vs_actual", "model_feature_importance", "model_rolling_errors"}

# A fast cross-section of the registry; the full set runs in tools/check_oracle.py.
SAMPLE = [
    "fact_results", "historical_seasons", "historical_incidents", "silver_race_data_races", "rule_time_to_ms",
    "rule_multi_format_date", "dq_bronze_report", "dq_failure_examples", "upsert_latest", "partitioned_scan",
    "feat_trailing_avg", "feat_team_momentum", "trend_pit_impact", "profile_fact_results", "csv_roundtrip",
    "stream_hourly", "layered_master", "ingest_summary", "dq_gold_report",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert len(df.columns) == 40 and df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    from paddock.plans.queries import REGISTRY

    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(REGISTRY) - set(sqls) == NO_ORACLE
    assert set(REGISTRY) <= set(qs) and set(sqls) <= set(qs)
    assert len(REGISTRY) >= 75


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    res = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_rows_only_queries_run(spark, name):
    assert entry_mod.queries()[name](spark, SF_SMALL).count() > 0
