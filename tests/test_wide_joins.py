"""The fact is shuffled once by race, whatever joins it there; repeated keys multiply as in plain joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paddock import session
from paddock.operators.features import team_momentum
from paddock.operators.sequence import trailing_mean
from paddock.plans import views
from paddock.plans.gold import GOLD_MODELS, GoldModels
from paddock.session import scratch_path

TABLES = {
    "race_data_races": ("raceid int, name string, round int, date date, time string, circuitid int, " + ", ".join(f"{s}_date date, {s}_time string" for s in ("fp1", "fp2", "fp3", "quali", "sprint")), [
        (i, f"R {n}", 1, None, None, c, *[None] * 10) for n, (i, c) in enumerate([(1, 1), (1, 2), (2, 1), (3, 9), (None, 1)])]),
    "race_data_circuits": ("circuitid int, circuitref string, name string, location string, country string, lat double, lng double, alt int", [
        (1, "a", "A", "x", "y", 1.0, 2.0, 3), (2, "b", "B", "x", "y", 1.0, 2.0, 3), (None, "n", "N", None, None, None, None, None)]),
    "race_data_drivers": ("driverid int, driverref string, number int, code string, forename string, surname string, dob date, nationality string", [
        (7, "a", 1, "AA", "A", "B", None, "x"), (7, "b", 2, "BB", "C", "D", None, "y"), (8, "c", 3, "CC", "E", "F", None, None), (None, "n", 4, "N", "N", "N", None, None)]),
    "race_data_constructors": ("constructorid int, constructorref string, name string, nationality string", [
        (5, "a", "T5", "x"), (6, "b", "T6", "y"), (6, "c", "T6b", "z")]),
    "race_data_status": ("statusid int, status string", [(1, "ok"), (2, "out")]),
    "race_data_results": ("raceid int, driverid int, constructorid int, number int, grid int, position int, positionorder int, points double, laps int, milliseconds int, fastestlap int, rank int, fastestlapspeed double, statusid int, positiontext string", [
        (r, d, t, 1, 2, 3, 3, 4.0, 5, 6, 7, 8, 9.0, s, "3") for r in (1, 2, 3, None) for d in (7, 8, 9, None) for t in (5, 6) for s in (1, 2)]),
    "race_data_pit_stops": ("raceid int, driverid int, stop int, lap int, time string, duration int, milliseconds int", [
        (1, 7, 1, 1, "t", 100, 1), (1, 7, 2, 1, "t", None, 1), (2, 8, 1, 1, "t", None, 1), (None, 7, 1, 1, "t", 5, 1), (1, 9, 1, 1, "t", 5, 1)]),
    "race_data_driver_standings": ("raceid int, driverid int, points double, position int, wins int", [
        (1, 7, 1.0, 1, 1), (1, 7, 2.0, 2, 1), (2, 8, 3.0, 1, 1), (None, 8, 4.0, 1, 1)]),
    "race_data_constructor_standings": ("raceid int, constructorid int, points double, position int, wins int", [
        (1, 5, 1.0, 1, 1), (2, 6, 2.0, 2, 1), (2, None, 3.0, 1, 1)]),
}


@pytest.fixture
def gold(spark):
    return GoldModels({n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items()}.__getitem__)


def plain_master(g):
    fr, r, c, d, t, sd, st = (g.ref(n).alias(a) for n, a in (("fact_results", "fr"), ("dim_races", "r"), ("dim_circuits", "c"), ("dim_drivers", "d"), ("dim_teams", "t"), ("standings_drivers", "sd"), ("standings_teams", "st")))
    j = fr.join(r, F.expr("fr.race_id = r.race_id")).join(c, F.expr("r.circuit_id = c.circuit_id")).join(d, F.expr("fr.driver_id = d.driver_id")).join(t, F.expr("fr.team_id = t.team_id"))
    j = j.join(sd, F.expr("fr.race_id = sd.race_id AND fr.driver_id = sd.driver_id"), "left").join(st, F.expr("fr.race_id = st.race_id AND fr.team_id = st.team_id"), "left")
    return j.select([F.col(src).alias(name) for src, name in views.MASTER_COLUMNS])


@pytest.mark.parametrize("width", [0, 7])
def test_repeated_and_null_keys_multiply_as_in_plain_joins(spark, gold, monkeypatch, width):
    monkeypatch.setattr(GoldModels, "width", lambda self, name="": width)
    rows = Counter(map(tuple, views.historical_master(gold).collect()))
    assert rows == Counter(map(tuple, plain_master(gold).collect())) and sum(rows.values()) > 100


def test_results_meet_all_of_a_race_in_one_shuffle(spark, gold, monkeypatch):
    monkeypatch.setattr(GoldModels, "width", lambda self, name="": 7)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.historical_master(gold)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    both = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and line.split("hashpartitioning(")[1].split(")")[0].count("#") > 1]
    assert both == []  # nothing goes by (race, driver) or (race, team) again
    assert all(", 7)" in line for line in plan.splitlines() if "Exchange hashpartitioning(race" in line)


def test_width_follows_the_input(spark, monkeypatch):
    path = scratch_path(spark, "width")
    spark.range(50_000).write.parquet(path)
    df = spark.read.parquet(path)
    size = session.file_bytes(df)
    assert size > 100_000 and session.join_width(df) == 0
    monkeypatch.setattr(session, "TASK_BYTES", size // 10)
    assert session.join_width(df) in (10, 11)


def test_a_wide_shuffle_setting_does_not_keep_the_width_from_the_input(spark, monkeypatch):
    """AQE would put its 200 tasks together to one a core."""
    path = scratch_path(spark, "wide-setting")
    spark.range(50_000).write.parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr(session, "TASK_BYTES", session.file_bytes(df) // 10)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert session.join_width(df) in (10, 11)
        assert session.spread(df, session.join_width(df), "id").rdd.getNumPartitions() in (10, 11)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_momentum_in_more_tasks_is_the_same(spark, gold):
    rows = lambda w: Counter(map(tuple, team_momentum(gold.ref("fact_results"), gold.ref("dim_races").dropDuplicates(["race_id"]).withColumn("race_date", F.expr("DATE'2024-01-01' + race_id")), width=w).collect()))
    assert rows(0) == rows(9)


def test_the_view_by_name_joins_as_the_frames(spark, gold):
    from paddock.sources import catalog

    root = scratch_path(spark, "wide-view")
    names = {k: f"{k}_{root.rsplit('-', 1)[-1]}" for k in ("gold", "dashboard")}
    catalog.create_layers(spark, names.values(), root)
    for m in GOLD_MODELS:
        if m.startswith(("dim_", "standings_")) or m == "fact_results":
            catalog.send_to_schema(gold.ref(m), m, names["gold"])
    for m in ("event_race_incidents", "event_fatal_accidents"):
        cells = views.INCIDENT_CELLS if m == "event_race_incidents" else views.ACCIDENT_CELLS
        cols = {src.removeprefix("CAST(").removesuffix(" AS INT)"): kind for src, _, kind in cells if src and not src.startswith("'")}
        spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in cols.items())).write.saveAsTable(f"{names['gold']}.{m}")
    catalog.create_dashboard_views(spark, names["gold"], names["dashboard"])
    got = Counter(map(tuple, spark.table(f"{names['dashboard']}.historical_master").collect()))
    assert got == Counter(map(tuple, plain_master(gold).collect()))


def test_trailing_mean_over_many_small_blocks(spark):
    rows = [(k, t, None if t % 5 == 0 else float(k * t)) for k in (1, 2) for t in range(40)] + [(3, 0, 1.0)]
    df = spark.createDataFrame(rows, "key int, t int, v double")
    got = {(r.key, r.t): r.m for r in trailing_mean(df, "key", ["t"], "v", 4, "m", partitions=30).collect()}
    for k, t, _ in rows:
        held = [v for kk, tt, v in rows if kk == k and t - 4 <= tt < t and v is not None]
        assert got[k, t] == (pytest.approx(sum(held) / len(held)) if held else None)
