"""Weather inside sessions, and the rolling validation of the model."""

import datetime as dt
import random

from pyspark.sql import functions as F

from paddock.operators import features, model

T0 = dt.datetime(1969, 12, 31, 20)  # slots before and after the epoch


def at(minutes, micros=0):
    return T0 + dt.timedelta(minutes=minutes, microseconds=micros)


def check(spark, sessions, readings):
    s = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sessions)], "k int, starts timestamp_ntz, ends timestamp_ntz")
    r = spark.createDataFrame(readings, "ts timestamp_ntz, value double")
    got = {x.k: (x.weather_readings, x.avg_weather) for x in features.weather_in_sessions(s, r).collect()}
    for k, (a, b) in enumerate(sessions):
        inside = [v for t, v in readings if t is not None and a <= t < b]
        known = [v for v in inside if v is not None]
        mean = sum(known) / len(known) if known else None
        assert got[k][0] == len(inside), (a, b)
        assert (got[k][1] is None) == (mean is None) and (mean is None or abs(got[k][1] - mean) < 1e-5)
    assert len(got) == len(sessions)


def test_interval_join_at_its_edges(spark):
    readings = [(at(m, u), float(m)) for m in range(0, 600, 5) for u in (-1, 0, 1)] + [(None, 1.0), (at(33), None)]
    sessions = [(at(a), at(a + n)) for a in (0, 3, 15, 29, 240) for n in (1, 14, 15, 16, 30, 61, 300)]
    sessions += [(at(10), at(10)), (at(20), at(10)), (at(5000), at(5100)), sessions[0], (at(15, 1), at(45, 1)), (at(15, -1), at(45, -1))]
    check(spark, sessions, readings)


def test_interval_join_with_a_hot_slot(spark):
    """A third of the readings within one minute, many of them at one time, and many sessions over it."""
    rng = random.Random(2)
    readings = [(at(100, rng.randrange(3) * 1_000_000), 1.0) for _ in range(2000)] + [(at(rng.randrange(2000), rng.randrange(60_000_000)), 2.0) for _ in range(4000)]
    sessions = [(a, a + dt.timedelta(minutes=rng.randint(1, 200))) for a in (at(rng.randrange(1900), rng.randrange(60_000_000)) for _ in range(150))]
    sessions += [(at(99, i * 900_000), at(100, i * 700_000)) for i in range(80)]
    check(spark, sessions, readings)


def test_no_cartesian_product(spark):
    s = spark.createDataFrame([], "k int, starts timestamp_ntz, ends timestamp_ntz")
    r = spark.createDataFrame([], "ts timestamp_ntz, value double")
    out = features.weather_in_sessions(s, r)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.collect() == []


def test_sessions_from_a_date_on(spark):
    races = spark.createDataFrame(
        [(1, "2023-03-05", "14:00:00", "2023-03-03", None), (2, "2022-03-05", "14:00:00", "2022-03-03", "11:30:00")], "raceid int, date string, time string, fp1_date string, fp1_time string"
    ).withColumns({c: F.lit(None).cast("string") for _, *d, _ in features.SESSIONS[2:] for c in d})
    races = races.withColumns({c: F.to_date(c) for c in races.columns if c.endswith("date")})
    got = {(r.raceid, r.session): (r.starts, r.ends) for r in features.session_intervals(races).collect()}
    assert got == {
        (1, "race"): (dt.datetime(2023, 3, 5, 14), dt.datetime(2023, 3, 5, 16)), (2, "race"): (dt.datetime(2022, 3, 5, 14), dt.datetime(2022, 3, 5, 16)),
        (2, "fp1"): (dt.datetime(2022, 3, 3, 11, 30), dt.datetime(2022, 3, 3, 12, 30)),
    }
    assert [r.raceid for r in features.session_intervals(races, since="2023-01-01").collect()] == [1]


def _features(spark, slope):
    rng = random.Random(5)
    rows = []
    for year in range(2000, 2008):
        for d in range(60):
            form = rng.random() * 10
            rows.append((d, year, 20.0 + slope * form + rng.random(), form, 0.1, 0.0, 1.0, 10, form * 2, 3.0))
    names = "driver_id int, year int, label double, prev_avg_points double, dnf_rate double, pace_delta double, position_variance double, prev_races int, team_momentum double, weather double"
    return spark.createDataFrame(rows, names), rows


def test_rolling_errors_use_earlier_seasons_only(spark):
    df, rows = _features(spark, 5.0)
    got = {r.season: r for r in model.rolling_errors(df, [2005, 2007]).collect()}
    plain = {r.season: r for r in model.plain_errors(df, 2005).collect()}
    assert sorted(got) == [2005, 2007] and sorted(plain) == [2005, 2006, 2007]
    for season, r in got.items():
        before = [x[2] for x in rows if x[1] < season]
        mean = sum(before) / len(before)
        mae = sum(abs(x[2] - mean) for x in rows if x[1] == season) / 60
        assert r.drivers == 60 and abs(r.plain_mean - mean) < 1e-3 and abs(r.plain_mae - mae) < 1e-3
        assert r.mae < 0.3 * r.plain_mae and r.rmse < 0.3 * r.plain_rmse  # a planted relation is found
    # seasons after the scored one don't matter
    changed = df.withColumn("label", F.when(F.col("year") > 2005, 0.0).otherwise(F.col("label")))
    assert model.rolling_errors(changed, [2005]).first()[:] == got[2005][:]


def test_gold_partitions_have_few_files(spark):
    import uuid

    from paddock.session import scratch_path
    from paddock.sources import catalog

    s = "g_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA {s} LOCATION '{scratch_path(spark, s)}'")
    df = spark.range(4000).repartition(16).withColumn("year", (F.col("id") % 5).cast("int"))
    catalog.send_to_schema(df, "fact", s, partition_by=["year"])
    t = spark.table(f"{s}.fact")
    assert t.count() == 4000 and len(t.inputFiles()) <= 10  # not 16 tasks times 5 seasons
