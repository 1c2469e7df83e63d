import datetime as dt

from pyspark.sql import functions as F

from paddock.operators import quality
from paddock.sources.bridge import read_table
from paddock.streaming import telemetry

from .conftest import SF_SMALL


def test_live_trigger_and_replay_are_idempotent(spark):
    schema, root = telemetry.scratch_tables(spark, "live-test")
    ev = read_table(spark, SF_SMALL, "events")
    per = telemetry.land_replay(ev, f"{root}/landing", chunks=3, redeliver=True, files_per_slice=2)
    q = telemetry.dedupe_into_table(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per),
        f"{schema}.events", f"{schema}.metrics", f"{root}/ckpt", live=True,
    )
    q.processAllAvailable()
    q.stop()
    out = telemetry.read_table_fresh(spark, f"{schema}.events")
    assert out.count() == ev.count() == out.select("event_id").distinct().count()
    # a restart from the same checkpoint finds nothing new and changes nothing
    q2 = telemetry.dedupe_into_table(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per),
        f"{schema}.events", f"{schema}.metrics", f"{root}/ckpt",
    )
    q2.awaitTermination()
    assert telemetry.read_table_fresh(spark, f"{schema}.events").count() == ev.count()
    # one report of the suite for each batch, of the rows the batch added
    m = telemetry.read_table_fresh(spark, f"{schema}.metrics").where("check_name = 'expect_not_null'")
    assert m.count() == 3 * m.select("batch_id").distinct().count()
    assert m.agg(F.sum("unexpected_count")).first()[0] == 0
    over = ev.where("value > 40 OR value < 0").count()
    between = telemetry.read_table_fresh(spark, f"{schema}.metrics").where("check_name = 'expect_between'")
    assert between.agg(F.sum("unexpected_count")).first()[0] == over


def test_hourly_windows_equal_batch(spark):
    schema, root = telemetry.scratch_tables(spark, "hourly-test")
    ev = read_table(spark, SF_SMALL, "events")
    per = telemetry.land_replay(ev, f"{root}/landing", chunks=4, files_per_slice=2)
    telemetry.hourly_telemetry(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per), f"{schema}.h", f"{root}/ckpt"
    ).awaitTermination()
    got = {(r.window_start, r.event_type): r.events for r in telemetry.read_table_fresh(spark, f"{schema}.h").collect()}
    want = {
        (r.h, r.event_type): r.n
        for r in ev.groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert got == want


def test_missing_column_check_fails_not_raises(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "raceid int, other string")
    checks = [quality.Check("not_null", "raceid"), quality.Check("not_null", "driverid"),
              quality.Check("match", "other", r"^\d+$"), quality.Check("absent", "url")]
    rows = {r.column_name: r for r in quality.check_table(df, "t", checks).collect()}
    assert rows["raceid"].success and rows["raceid"].unexpected_count == 0
    assert not rows["driverid"].success and rows["driverid"].unexpected_count is None
    assert not rows["other"].success and rows["other"].first_example == "x"
    assert rows["url"].success


def test_failure_examples_top_k(spark):
    df = spark.createDataFrame([(f"{c}",) for c in "RDENFWRRR"] + [("1",)], "positiontext string")
    ex = quality.failure_examples(df, "race_data_results", [("expect_not_match_regex", "positiontext")], k=5)
    assert ex.first().examples == "D, E, F, N, R"


def test_profile_counts(spark):
    from paddock.operators import profile

    df = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1)), (2, None, None), (2, "a", None)], "k int, s string, d date")
    rows = {r.column_name: r for r in profile.profile(df, "t", df.columns).collect()}
    assert rows["k"].distinct_count == 2 and rows["s"].null_count == 1 and rows["d"].null_count == 2
    assert rows["d"].data_type == "date" and rows["k"].row_count == 3


def test_profile_approx_distinct(spark):
    from paddock.operators import profile

    df = spark.range(5000).selectExpr("id % 100 AS k", "CAST(NULL AS STRING) AS s")
    rows = {r.column_name: r for r in profile.profile(df, "t", approx=True).collect()}
    assert abs(rows["k"].distinct_count - 100) <= 5 and rows["s"].null_count == 5000


def test_gate_stops_on_a_duplicate_key(spark):
    import pytest

    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "race_id long, race_key string")
    report = quality.check_table(df, "dim_races", quality.GOLD_SUITES["dim_races"])
    assert {r.column_name: r.unexpected_count for r in report.collect()} == {"race_id": 1, "race_key": 1}
    with pytest.raises(quality.QualityGateError, match="dim_races.race_key: expect_unique"):
        quality.gate(report)


def test_suites_hold_the_expected_checks():
    from paddock.plans import oracle_checks as expected
    from paddock.sources.registry import SOURCE_TABLES

    have = [(t, c.kind, c.column, quality.rule_text(c)) for t in SOURCE_TABLES for c in quality.suite_for(t)]
    assert have == [(e.table, e.kind, e.column, expected.rule(e)) for e in expected.SILVER]
    gold = [(m, c.kind, c.column, quality.rule_text(c)) for m, cs in sorted(quality.GOLD_SUITES.items()) for c in cs]
    assert gold == [(e.table, e.kind, e.column, expected.rule(e)) for e in expected.GOLD]


def test_states_of_parts_add_up_to_the_whole(spark):
    import random

    import pytest

    from paddock.session import scratch_path
    from paddock.sources.catalog import check_parts
    from paddock.sources.versions import VersionedTable

    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 50]), rng.choice(["F", "12", None]), rng.choice([None, 1999, 2000, 2001])) for _ in range(500)]
    df = spark.createDataFrame(rows, "positionorder int, positiontext string, season int")
    store = VersionedTable(spark, scratch_path(spark, "states"))
    part = F.col("season")
    check_parts(store, df.where("season IS NULL OR season <= 2000").withColumn("positionorder", F.lit(99)), "race_data_results", part)  # to be replaced
    check_parts(store, df, "race_data_results", part, [None, "1999", "2000"])
    report = check_parts(store, df, "race_data_results", part, ["2001"])
    want = quality.check_table(df, "race_data_results")
    assert sorted(map(tuple, report.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert {r.part for r in store.read().collect()} == {None, "1999", "2000", "2001"}
    with pytest.raises(ValueError, match="uniqueness"):
        quality.check_states(df, "t", part, [quality.Check("unique", "season")])
