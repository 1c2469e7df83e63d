"""Sinks that commit whole batches, quarantine, latency and two live feeds."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paddock.sources.bridge import read_table
from paddock.sources.versions import VersionedTable
from paddock.streaming import telemetry

from .conftest import SF_SMALL

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
T0 = dt.datetime(2024, 1, 1, 12)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def rows():
    """Good events, some over two days, without ids, times or values, and twins that differ in one cell."""
    out = [(i, at(17 * i), i % 3, "click", float(i % 30), "p") for i in range(120)]
    out += [(None, at(5), 1, "click", 1.0, "a"), (None, at(5), 1, "click", 1.0, "b"), (None, None, 2, "view", 2.0, None), (200, None, 1, "click", 3.0, None)]
    return out + [(201, at(9), 1, "CLICK", 50.0, None), (202, at(9), 1, None, None, None)]


def run_split(spark, schema, root, per):
    stream = telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per, arrival=True)
    return telemetry.split_into_tables(stream, f"{schema}.good", f"{schema}.bad", f"{schema}.latency", f"{root}/ckpt")


def content(df):
    return Counter(map(tuple, df.select("event_id", "ts", "user_id", "event_type", "value", "props").collect()))


def bad_ids(df):
    return Counter((r.event_id, r.props, tuple(r.reasons)) for r in df.collect())


WANT_BAD = Counter(
    [
        (None, "a", ("event_id IS NOT NULL",)), (None, "b", ("event_id IS NOT NULL",)), (None, None, ("event_id IS NOT NULL", "ts IS NOT NULL")),
        (200, None, ("ts IS NOT NULL",)), (201, None, ("value BETWEEN 0 AND 40", "event_type RLIKE ^[a-z]+$")), (202, None, ("value IS NOT NULL",)),
    ]
)


@pytest.mark.parametrize("dies", ["good", "bad", "latency"])
def test_a_batch_that_dies_between_its_writes_counts_once(spark, monkeypatch, dies):
    schema, root = telemetry.scratch_tables(spark, "killed")
    df = spark.createDataFrame(rows(), SCHEMA)
    per = telemetry.land_replay(df, f"{root}/landing", chunks=2, redeliver=True, files_per_slice=1)
    commit, left = VersionedTable._commit, [2]

    def once(self, v):
        if self.root.endswith(f"/{dies}"):
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError("executor lost")
        return commit(self, v)

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", once)
        with pytest.raises(Exception, match="executor lost"):
            run_split(spark, schema, root, per).awaitTermination()
    run_split(spark, schema, root, per).awaitTermination()
    good, bad, latency = (telemetry.read_table_fresh(spark, f"{schema}.{n}") for n in ("good", "bad", "latency"))
    assert content(good) + content(bad) == Counter(rows())
    assert bad_ids(bad) == WANT_BAD
    assert Counter(r.batch_id for r in latency.collect()) == {0: 1, 1: 1, 2: 1, 3: 1}
    assert latency.agg(F.sum("rows")).first()[0] == 2 * len(rows())


def test_events_without_an_id_are_kept_apart(spark):
    schema, root = telemetry.scratch_tables(spark, "no-ids")
    df = spark.createDataFrame([(None, at(i), 1, "click", 1.0, "p") for i in range(30)] + [(1, at(0), 1, "click", 1.0, "p")], SCHEMA)
    per = telemetry.land_replay(df, f"{root}/landing", chunks=3, redeliver=True)
    telemetry.dedupe_into_table(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per), f"{schema}.events", f"{schema}.metrics", f"{root}/ckpt"
    ).awaitTermination()
    out = telemetry.read_table_fresh(spark, f"{schema}.events")
    assert content(out) == content(df)


def test_latency_is_bounded_live(spark):
    """Files that land while the query runs: event to table within the trigger and a batch's work."""
    schema, root = telemetry.scratch_tables(spark, "latency")
    df = spark.createDataFrame(rows(), SCHEMA)
    per = telemetry.land_replay(df, f"{root}/landing", chunks=1)
    stream = telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per, arrival=True)
    q = telemetry.split_into_tables(stream, f"{schema}.good", f"{schema}.bad", f"{schema}.latency", f"{root}/ckpt", live=True)
    q.processAllAvailable()
    for _ in range(3):
        telemetry.land_replay(df, f"{root}/landing", chunks=1)
        q.processAllAvailable()
    q.stop()
    got = telemetry.read_table_fresh(spark, f"{schema}.latency").orderBy("batch_id").collect()
    assert sum(r.rows for r in got) == 4 * len(rows())
    assert all(0 <= r.fastest_ms <= r.slowest_ms for r in got)
    assert min(r.slowest_ms for r in got[1:]) < 30_000  # some 2-5 s on an idle machine
    assert telemetry.read_table_fresh(spark, f"{schema}.good").count() == 120


def test_live_feeds_with_late_rows_equal_batch(spark):
    schema, root = telemetry.scratch_tables(spark, "feeds")
    ev = read_table(spark, SF_SMALL, "events")
    weather, fast = ev.where("event_type = 'purchase'"), ev.where("event_type <> 'purchase'")
    land = {"chunks": 3, "files_per_slice": 2, "late": "40 MINUTES", "close": "1 DAY"}
    pw = telemetry.land_replay(weather, f"{root}/weather", **land)
    pt = telemetry.land_replay(fast, f"{root}/fast", **land)
    q = telemetry.live_feeds(
        telemetry.replay_stream(spark, f"{root}/fast", files_per_trigger=pt), telemetry.replay_stream(spark, f"{root}/weather", files_per_trigger=pw),
        f"{schema}.joined", f"{root}/ckpt", within=3600, state_partitions=2,
    )
    q.awaitTermination()
    readings = sorted((r.ts, r.value) for r in weather.collect())
    want = Counter()
    for r in fast.collect():
        near = [x for x in readings if r.ts - dt.timedelta(hours=1) < x[0] <= r.ts]
        want[r.event_id, *(near[-1] if near else (None, None))] += 1
    out = telemetry.read_table_fresh(spark, f"{schema}.joined")
    assert Counter((r.event_id, r.reading_ts, r.reading) for r in out.collect()) == want
    # state of both sides goes as the watermark passes
    last = q.lastProgress.stateOperators[0]
    assert last.numRowsTotal < 20 and q.exception() is None


def test_live_feeds_make_no_pairs_in_a_dense_hour(spark, monkeypatch):
    """Events that share ten minutes with many readings reach the sink once a
    batch, each with the newest: equal times count, one of ten minutes ago doesn't."""
    schema, root = telemetry.scratch_tables(spark, "dense")
    second = lambda s: T0 + dt.timedelta(seconds=s)
    fast = [(i, second(3 * i), 1, "click", float(i), "p") for i in range(600)] + [(900, second(-1), 1, "click", 0.0, "p"), (901, second(2 * 1797 + 600), 1, "click", 0.0, "p")]
    slow = [(1000 + i, second(2 * i), 2, "purchase", None if i % 7 == 0 else float(i), "w") for i in range(900)] + [(1900, second(2 * 1797), 2, "purchase", 5.0, "w")]
    land = {"chunks": 2, "late": "5 MINUTES", "close": "1 DAY"}
    pt = telemetry.land_replay(spark.createDataFrame(fast, SCHEMA), f"{root}/fast", **land)
    pw = telemetry.land_replay(spark.createDataFrame(slow, SCHEMA), f"{root}/weather", **land)
    upsert_of, sent = telemetry.latest_upsert, []

    def counted(*args):
        upsert = upsert_of(*args)

        def run(batch, batch_id):
            sent.append(batch.count())
            upsert(batch, batch_id)

        return run

    monkeypatch.setattr(telemetry, "latest_upsert", counted)
    telemetry.live_feeds(
        telemetry.replay_stream(spark, f"{root}/fast", files_per_trigger=pt), telemetry.replay_stream(spark, f"{root}/weather", files_per_trigger=pw),
        f"{schema}.joined", f"{root}/ckpt", state_partitions=2,
    ).awaitTermination()
    got = Counter((r.event_id, r.reading_ts, r.reading) for r in telemetry.read_table_fresh(spark, f"{schema}.joined").collect())
    want = Counter()
    for i, ts, *_ in fast:
        near = [(t, v) for _, t, _, _, v, _ in slow if ts - dt.timedelta(seconds=600) < t <= ts]
        want[i, *(max(near, key=lambda x: x[0]) if near else (None, None))] += 1
    assert got == want and want[901, None, None] == want[900, None, None] == 1
    assert sum(sent) <= 3 * len(fast)
