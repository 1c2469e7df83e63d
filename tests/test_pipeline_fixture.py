import datetime as dt

import pytest

from paddock.operators import quality
from paddock.operators.clean import to_silver
from paddock.plans import views
from paddock.plans.gold import GoldModels

from .fixtures import bronze_tables


@pytest.fixture(scope="module")
def gold(spark):
    bronze = bronze_tables(spark)
    silver = {n: to_silver(df, n) for n, df in bronze.items()}
    return GoldModels(silver.__getitem__), silver


def test_silver_results_cleaned(gold):
    _, silver = gold
    rows = {r.resultid: r for r in silver["race_data_results"].collect()}
    assert rows[2].position is None and rows[2].positiontext == "Retired" and rows[2].grid == 0
    assert rows[1].fastestlaptime == 87452 and rows[3].fastestlaptime == 91500 and rows[4].fastestlaptime == 83000
    assert rows[1].fastestlapspeed == 220.1 and "time" not in silver["race_data_results"].columns


def test_silver_dates_clock_and_drop(gold):
    _, silver = gold
    races = {r.raceid: r for r in silver["race_data_races"].collect()}
    assert "year" not in silver["race_data_races"].columns and "url" not in silver["race_data_races"].columns
    assert races[100].date == dt.date(2024, 3, 24) and races[100].time == "04:00:00"
    assert races[101].sprint_time == "10:30:00" and races[102].time is None
    drivers = {r.driverid: r for r in silver["race_data_drivers"].collect()}
    assert drivers[1].forename == "Lewis" and drivers[1].surname == "Hamilton" and drivers[1].number == 44
    assert drivers[2].dob == dt.date(1997, 9, 30) and drivers[3].dob == dt.date(1931, 10, 24)
    assert drivers[2].number is None
    circuits = {r.circuitid: r.country for r in silver["race_data_circuits"].collect()}
    assert circuits == {1: "Australia", 2: "United Kingdom", 3: "United Arab Emirates"}


def test_silver_events(gold):
    _, silver = gold
    causes = sorted(r.cause for r in silver["race_events_safety_cars"].collect())
    assert causes == ["Accident(s)", "Rain"]
    flags = {r.incident: (r.resumed, r.excluded) for r in silver["race_events_red_flags"].collect()}
    assert flags == {"Heavy rain": ("Resumed", None), "Crash": (None, "Max")}


def test_fact_results(gold):
    g, _ = gold
    rows = {(r.race_key, r.driver_id): r for r in g.ref("fact_results").collect()}
    ham = rows[("2024_Australian_Grand_Prix", 1)]
    assert ham.pit_stop_count == 2 and ham.total_pit_time_ms == 23456 + 62345
    assert ham.dnf_flag is False and ham.positions_gained == 0 and ham.status == "Finished"
    ver = rows[("2024_Australian_Grand_Prix", 2)]
    assert ver.pit_stop_count == 0 and ver.total_pit_time_ms == 0  # no stops: default 0
    assert ver.dnf_flag is True and ver.positions_gained == -2  # grid 0 gives a negative
    # two races named "British Grand Prix" in 2024 share a race_key but do not merge
    brit = [r for r in g.ref("fact_results").collect() if r.race_key == "2024_British_Grand_Prix"]
    assert len(brit) == 1 and brit[0].pit_stop_count == 1


def test_master_view_left_joins(gold):
    g, _ = gold
    m = views.historical_master(g)
    assert len(m.columns) == 40
    rows = {(r["Race Key"], r["Driver ID"]): r for r in m.collect()}
    assert rows[("2024_Abu_Dhabi_Grand_Prix", 2)]["Driver Championship Points"] is None
    assert rows[("2024_Australian_Grand_Prix", 1)]["Team Championship Points"] == 25.0
    assert views.historical_seasons(m).count() == 4  # race key stays in the DISTINCT (race x driver grain)
    assert len(views.historical_overview(m).columns) == 19


def test_event_unions(gold):
    g, _ = gold
    inc = views.historical_incidents(g.ref("event_race_incidents"), g.ref("event_fatal_accidents"))
    assert inc.count() == 6 and len(inc.columns) == 15
    acc = {r.type: r.date_of_accident for r in g.ref("event_fatal_accidents").collect()}
    assert acc == {"Driver": dt.date(1971, 10, 24), "Marshal": dt.date(1952, 6, 7)}


def test_quality_silver_passes_bronze_fails(spark, gold):
    _, silver = gold
    bronze = bronze_tables(spark)
    s_report = quality.check_tables(silver.__getitem__, sorted(silver))
    b_report = quality.check_tables(bronze.__getitem__, sorted(bronze))
    assert s_report.where("NOT success").count() == 0
    failed = {(r.table_name, r.check_name, r.column_name) for r in b_report.where("NOT success").collect()}
    assert ("race_data_races", "expect_column_absent", "url") in failed
    assert ("race_data_races", "expect_column_absent", "year") in failed
    assert ("race_data_results", "expect_not_match_regex", "positiontext") in failed
    assert ("race_data_results", "expect_of_type", "position") in failed
    quality.gate(s_report)
    with pytest.raises(quality.QualityGateError):
        quality.gate(b_report)


def test_eager_pit_aggregates_equal_join_then_aggregate(spark):
    from paddock.plans.gold import fact_pit_stops, pit_aggregates, pit_aggregates_eager

    stops = spark.createDataFrame(
        [(1, 7, 1, 10, "t", 100, "x"), (1, 7, 2, 20, "t", None, "x"), (2, 7, 1, 5, "t", 300, "x"), (3, 9, 1, 1, "t", 5, "x")],
        "raceid int, driverid int, stop int, lap int, time string, duration int, milliseconds string",
    )
    # race 1 appears twice in the dimension and driver 9 is missing: both must behave like the joins
    races = spark.createDataFrame([(1, "k1", 2024), (1, "k1b", 2024), (2, "k2", 2024), (3, "k3", 2024)],
                                  "race_id int, race_key string, year int")
    drivers = spark.createDataFrame([(7, "A", "B")], "driverid int, forename string, surname string")
    want = sorted(tuple(r) for r in pit_aggregates(fact_pit_stops(stops, races, drivers)).collect())
    got = sorted(tuple(r) for r in pit_aggregates_eager(stops, races, drivers).collect())
    assert got == want == [(1, 7, 4, 200), (2, 7, 1, 300)]


def test_catalog_layers_and_persistent_views(spark, gold):
    from paddock.session import scratch_path
    from paddock.sources import catalog

    _, silver = gold
    root = scratch_path(spark, "views-test")
    sfx = root.rsplit("-", 1)[-1]
    names = {k: f"{k}_{sfx}" for k in ("silver", "gold", "dashboard")}
    catalog.create_layers(spark, names.values(), root)
    for t, df in silver.items():
        catalog.send_to_schema(df, t, names["silver"])
    catalog.build_gold(spark, names["silver"], names["gold"], workers=3)
    assert set(catalog.list_tables(spark, names["gold"])) >= {"fact_results", "dim_races", "standings_teams"}
    catalog.create_dashboard_views(spark, names["gold"], names["dashboard"])
    master = spark.table(f"{names['dashboard']}.historical_master")
    assert master.count() == 4 and len(master.columns) == 40
    assert len(spark.table(f"{names['dashboard']}.historical_overview").columns) == 19
    assert len(spark.table(f"{names['dashboard']}.historical_drivers_teams").columns) == 24
    assert spark.table(f"{names['dashboard']}.historical_seasons").count() == 4
