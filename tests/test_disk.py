"""Shuffles of large builds: gone with the step that made them, and without the columns of what is broadcast."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paddock import session
from paddock.plans import views
from paddock.plans.gold import GOLD_MODELS, GoldModels
from paddock.session import scratch_path
from paddock.sources import catalog, ingest

from .test_wide_joins import TABLES, plain_master


@pytest.fixture
def written(spark, monkeypatch):
    """The tables as files, whose size asks for wide joins (two tasks and more)."""
    root = scratch_path(spark, "written")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}")
    monkeypatch.setattr(session, "TASK_BYTES", 500)
    return {name: spark.read.parquet(f"{root}/{name}") for name in TABLES}.__getitem__


@pytest.fixture
def small_limit(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("most", [0, 400_000])
def test_dimensions_of_few_rows_meet_the_master_last(spark, written, small_limit, monkeypatch, most):
    monkeypatch.setattr(session, "BROADCAST_ROWS", most)
    gold = GoldModels(written)
    assert gold.width() > 4
    master = views.historical_master(gold)
    by_key = [x for x in exchanges(master) if "REPARTITION_BY_NUM" in x and ("driverid" in x or "constructorid" in x)]
    assert bool(by_key) == (most == 0)
    rows = Counter(map(tuple, master.collect()))
    assert rows == Counter(map(tuple, plain_master(GoldModels(written)).collect())) and sum(rows.values()) > 100


@pytest.mark.parametrize("most", [0, 400_000])
def test_models_of_wide_joins_have_the_rows_of_plain_ones(spark, written, small_limit, monkeypatch, most):
    monkeypatch.setattr(session, "BROADCAST_ROWS", most)
    plain = GoldModels({n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items()}.__getitem__)
    wide = GoldModels(written, together="year")
    assert plain.width() == 0 < wide.width()
    for m in ("fact_results", "fact_pit_stops", "standings_drivers", "standings_teams"):
        assert wide.ref(m).columns == plain.ref(m).columns and wide.ref(m).dtypes == plain.ref(m).dtypes
        assert Counter(map(tuple, wide.ref(m).collect())) == Counter(map(tuple, plain.ref(m).collect()))


def test_no_broadcast_where_it_is_turned_off(spark, written):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not session.broadcasts(written("race_data_drivers"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


@pytest.mark.parametrize("most", [0, 400_000])
def test_the_view_does_not_shuffle_the_fact_for_its_driver_or_team(spark, written, small_limit, monkeypatch, most):
    monkeypatch.setattr(session, "BROADCAST_ROWS", most)
    gold = GoldModels(written)
    root = scratch_path(spark, "narrow-view")
    names = {k: f"{k}_{root.rsplit('-', 1)[-1]}" for k in ("gold", "dashboard")}
    catalog.create_layers(spark, names.values(), root)
    for m in GOLD_MODELS:
        if m.startswith(("dim_", "standings_")) or m == "fact_results":
            catalog.send_to_schema(gold.ref(m), m, names["gold"])
    for m, cells in (("event_race_incidents", views.INCIDENT_CELLS), ("event_fatal_accidents", views.ACCIDENT_CELLS)):
        cols = {src.removeprefix("CAST(").removesuffix(" AS INT)"): kind for src, _, kind in cells if src and not src.startswith("'")}
        spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in cols.items())).write.saveAsTable(f"{names['gold']}.{m}")
    catalog.create_dashboard_views(spark, names["gold"], names["dashboard"])
    master = spark.table(f"{names['dashboard']}.historical_master")
    plan = master._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "RepartitionByExpression [team_id" in line]
    assert len(wide) == (2 if most == 0 else 0)  # the pairs and the teams
    assert Counter(map(tuple, master.collect())) == Counter(map(tuple, plain_master(GoldModels(written)).collect()))


def test_a_step_leaves_no_shuffle_setting_behind(spark):
    was = spark.conf.get(session.CLEANUP)
    with session.dropped_shuffles(spark):
        assert spark.conf.get(session.CLEANUP) == "true"
        rows = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
        assert rows.count() == 7 and len(rows.collect()) == 7
    assert spark.conf.get(session.CLEANUP) == was


def test_layers_are_written_without_their_shuffles(spark, monkeypatch):
    seen = []
    write = catalog.send_to_schema
    monkeypatch.setattr(catalog, "send_to_schema", lambda df, *a, **k: (seen.append(spark.conf.get(session.CLEANUP)), write(df, *a, **k)))
    root = scratch_path(spark, "dropped")
    names = {k: f"{k}_{root.rsplit('-', 1)[-1]}" for k in ("silver", "gold")}
    catalog.create_layers(spark, names.values(), root)
    was = spark.conf.get(session.CLEANUP)
    silver = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items() if n in ("race_data_races", "race_data_drivers", "race_data_pit_stops")}
    catalog.write_layer(silver, names["silver"])
    catalog.build_gold(spark, names["silver"], names["gold"], ("dim_races", "fact_pit_stops"))
    assert seen == ["true"] * 5 and spark.conf.get(session.CLEANUP) == was
    assert spark.table(f"{names['gold']}.fact_pit_stops").count() == GoldModels(lambda n: silver[n]).ref("fact_pit_stops").count()


def test_large_models_are_written_in_turn_the_largest_first(spark, monkeypatch):
    root = scratch_path(spark, "turn")
    names = {k: f"{k}_{root.rsplit('-', 1)[-1]}" for k in ("silver", "gold")}
    catalog.create_layers(spark, names.values(), root)
    tables = ("race_data_races", "race_data_drivers", "race_data_pit_stops", "race_data_driver_standings", "race_data_results")
    catalog.write_layer({n: spark.createDataFrame(TABLES[n][1], TABLES[n][0]) for n in tables}, names["silver"])
    monkeypatch.setattr(session, "TASK_BYTES", 300)
    events, write = [], catalog.send_to_schema

    def watched(df, name, *a, **k):
        events.append(name)
        write(df, name, *a, **k)
        events.append(name)

    monkeypatch.setattr(catalog, "send_to_schema", watched)
    models = ("dim_races", "fact_pit_stops", "standings_drivers", "dim_sessions")
    catalog.build_gold(spark, names["silver"], names["gold"], models)
    assert events[::2] == events[1::2] and set(events) == set(models)  # none begins before the last has ended


def test_ingested_tables_are_compressed_as_the_layers(spark):
    root = scratch_path(spark, "zstd-bronze")
    name = f"bronze_{root.rsplit('-', 1)[-1]}"
    catalog.create_layers(spark, [name], root)
    ingest.write_csv(spark.createDataFrame([(1, "a")], "statusId int, status string"), f"{root}/race_data/status.csv")
    files, _ = ingest.list_csv_files(spark, [f"{root}/race_data"])
    assert ingest.ingest_files(spark, files, name).first().status == "succeeded"
    assert all(".zstd." in f for f in spark.table(f"{name}.race_data_status").inputFiles())
