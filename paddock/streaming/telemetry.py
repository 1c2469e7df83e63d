"""Structured Streaming for the telemetry feed.

* ``land_replay``: replay a historical session by landing its events as
  a sequence of files in event-time order (the stand-in for a topic; with
  the Kafka connector on the classpath ``kafka_source`` reads the topic).
* ``hourly_telemetry``: watermark + tumbling window aggregate, written
  by ``foreachBatch`` as a keyed latest-wins upsert (update mode), so the
  table always holds the current value of every window.
* ``dedupe_into_table``: at-least-once delivery made exactly-once: the
  stream drops duplicates within the watermark, and each micro-batch is
  checked (quality counts kept by batch) and inserted only for events
  not yet in the table.
* ``split_into_tables``: rows that fail the suite go to a quarantine table
  with their reasons, the others to the table; the latency from landing to
  commit is kept by batch.
* ``weather_buckets`` + ``telemetry_with_weather``: the slower second
  feed aggregated per 15-minute bucket, then joined to the fast feed
  (stream-static left join on the bucket: one match per event, no pairs).
* ``live_feeds``: both feeds as streams, outer-joined by time with
  watermarks on both sides; each event takes its newest reading, found in one
  pass over a time window's rows.

Tables are ``VersionedTable``s: a micro-batch writes its files and then
commits them with its number in one step, so one that dies half-way leaves
the table as it was and one that runs again changes nothing.

Event time: the provided ``ts`` is ``timestamp_ntz``; watermarks need
``timestamp``, so it is cast on the way in (session time zone UTC) and
window bounds go back to ``timestamp_ntz`` on the way out. Rows without an
event time are in no window; ``split_into_tables`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import Check, check_table, failing
from ..session import scratch_path
from ..sources.upsert import latest_per_key, new_rows
from ..sources.versions import VersionedTable

LIVE_TRIGGER = "2 seconds"  # the 3-5 s event-to-table budget of the live feed
END = "__end__"  # the type of the row that closes a replay
ARRIVED = "_arrived"  # when a row's file landed


def land_replay(
    events: DataFrame, folder: str, chunks: int = 6, redeliver: bool = False, files_per_slice: int = 1,
    late: str | None = None, close: str | None = None,
) -> int:
    """Write ``events`` as ``chunks`` slices in event-time order (one write
    per time slice, so file modification times follow event time), each
    slice as ``files_per_slice`` files; rows without a time land with the
    first. With ``redeliver`` every slice lands twice, like a producer
    retrying. With ``late`` (an interval), every other row of a slice's last
    such stretch lands with the next slice, after rows that are newer. With
    ``close`` (an interval) a last delivery holds one row, of type ``END``,
    that much after the end, so that watermarks pass all rows before.
    Returns the files per delivery, the ``maxFilesPerTrigger`` that makes one
    micro-batch of each delivery (so a redelivery is a later batch)."""
    bounds = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    if lo is None:  # an empty feed lands nothing
        return files_per_slice
    step = (hi - lo) / chunks

    def at(t) -> F.Column:
        return F.expr(f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'")

    for i in range(chunks):
        start = lo + step * i
        began = F.col("ts") >= at(start)
        cond = began | F.col("ts").isNull() if i == 0 else began
        if i < chunks - 1:
            cond = cond & ~F.coalesce(F.col("ts") >= at(start + step), F.lit(False))
        if late:
            delayed = lambda end: (F.col("ts") >= at(end) - F.expr(f"INTERVAL {late}")) & (F.col("ts") < at(end)) & (F.pmod(F.xxhash64("ts"), F.lit(2)) == 0)
            if i < chunks - 1:
                cond = cond & ~F.coalesce(delayed(start + step), F.lit(False))
            if i:
                cond = cond | delayed(start)
        for _ in range(2 if redeliver else 1):
            events.where(cond).repartition(files_per_slice).write.mode("append").parquet(folder)
    if close:
        none = {f.name: F.lit(None).cast(f.dataType) for f in events.schema.fields}
        none |= {"ts": at(hi) + F.expr(f"INTERVAL {close}"), "event_type": F.lit(END)}
        events.sparkSession.range(1).select(*(c.alias(n) for n, c in none.items())).write.mode("append").parquet(folder)
    return files_per_slice


def replay_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1, arrival: bool = False) -> DataFrame:
    """The landed files as a stream; with ``arrival`` when each row's file landed."""
    schema = spark.read.parquet(folder).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    if arrival:
        raw = raw.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def kafka_source(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """The live feed: JSON messages from a topic (needs the Kafka connector)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def _run(writer, checkpoint: str, live: bool, state_partitions: int | None = None) -> StreamingQuery:
    """Start a query with its checkpoint in the shared folder.

    The number of state-store partitions is fixed by the shuffle width in
    force when a query first starts (and then kept in its checkpoint); it
    is pinned here to ``state_partitions`` (default: the cluster's
    parallelism) so a session-wide shuffle width meant for batch jobs does
    not decide it.
    """
    spark = SparkSession.getActiveSession()
    n = state_partitions or spark.sparkContext.defaultParallelism
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=LIVE_TRIGGER) if live else writer.trigger(availableNow=True)
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """AQE for the jobs of a ``foreachBatch`` function: the engine turns it off
    for a stream's session, as state must keep its partitions, but what a sink
    makes of a finished batch is ordinary work."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def _touched(batch: DataFrame, part: str) -> list:
    """Distinct partition values of a micro-batch (a handful of days)."""
    return [r[0] for r in batch.select(part).distinct().collect()]


def table_of(spark: SparkSession, table: str) -> VersionedTable:
    """The versioned table ``schema.name``, in the schema's folder."""
    schema, name = table.split(".")
    return VersionedTable(spark, f"{spark.catalog.getDatabase(schema).locationUri}/{name}")


def latest_upsert(table: str, keys: list[str], part: str, order: tuple[str, ...] = ("_batch",)):
    """A ``foreachBatch`` function keeping the newest version of each key
    in a table partitioned by ``part``, a function of the key.

    Only the partitions the batch touches are read (their files, by the
    manifest), merged with the batch (latest by ``order`` per key, a partially
    aggregated max) and written as new files, which take their place as the
    batch is committed: the cost of a batch follows the batch, not the table.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        t = table_of(batch.sparkSession, table)
        v = t.version()
        if v.batches.get("", -1) >= batch_id:
            return
        rows = batch.withColumn("_batch", F.lit(batch_id)).persist()
        try:
            parts = _touched(rows, part)  # the stateful plan runs here, once
            with _adaptive(batch.sparkSession):
                gone = t.in_partitions(parts, v) if v.number else ()
                merged = latest_per_key(t.read(gone).unionByName(rows) if gone else rows, keys, list(order))
                t.change(merged, gone, batch=batch_id, partition_by=(part,), since=v)
        finally:
            rows.unpersist()

    return upsert


def hourly_telemetry(stream: DataFrame, table: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Events and value sum per hour and event type, upserted per window."""
    agg = (
        stream.withWatermark("ts", "1 hour")
        .groupBy(F.window("ts", "1 hour"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value_sum"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "event_type",
            "events",
            F.round("value_sum", 2).alias("value_sum"),
        )
        .withColumn("window_date", F.to_date("window_start"))
    )
    upsert = latest_upsert(table, ["window_start", "event_type"], "window_date")
    return _run(agg.writeStream.outputMode("update").foreachBatch(upsert), checkpoint, live)


#: the suite of the event stream
STREAM_CHECKS = [
    Check("not_null", "event_id"), Check("not_null", "ts"), Check("not_null", "value"),
    Check("between", "value", (0, 40)), Check("match", "event_type", r"^[a-z]+$"),
]


def event_key(df: DataFrame) -> DataFrame:
    """``df`` with ``_key``: the event's id, or for an event without one a
    digest of all of it, so such events are told apart."""
    content = F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns) if not c.startswith("_"))), {"ignoreNullFields": "false"}), 256)
    return df.withColumn("_key", F.coalesce(F.col("event_id").cast("string"), F.concat(F.lit("#"), content)))


def _plain(batch: DataFrame) -> DataFrame:
    return batch.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("event_date", F.to_date("ts"))


def dedupe_into_table(stream: DataFrame, table: str, metrics_table: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Insert each event once (events without an id by their content); the
    quality suite runs on the rows that each batch adds, and its report is kept
    by batch.

    The table is partitioned by event date; a redelivery lands within the
    watermark, so each batch is checked only against the dates it touches
    (their files), not the whole table."""
    deduped = event_key(stream.withWatermark("ts", "1 hour")).dropDuplicatesWithinWatermark(["_key"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        t = table_of(spark, table)
        v = t.version()
        if v.batches.get("", -1) >= batch_id:
            return
        rows = _plain(batch).persist()
        add = rows
        try:
            dates = _touched(rows, "event_date")  # the stateful plan runs here, once
            with _adaptive(spark):
                if v.number:
                    add = new_rows(t.read(t.in_partitions(dates, v)), rows, ["_key"]).persist()
                # the report first: a batch that dies after it finds it in place and adds its rows
                report = check_table(add, "events", STREAM_CHECKS).withColumn("batch_id", F.lit(batch_id))
                table_of(spark, metrics_table).append(report, batch=batch_id)
                t.change(add, batch=batch_id, partition_by=("event_date",), since=v)
        finally:
            add.unpersist()
            rows.unpersist()

    return _run(deduped.writeStream.foreachBatch(sink), checkpoint, live)


def _latency(rows: DataFrame, batch_id: int) -> DataFrame:
    """One row: how long the batch's rows took from landing until now."""
    now = F.current_timestamp()
    since = lambda c: F.unix_millis(now) - F.unix_millis(c)
    took = rows.agg(F.count(F.lit(1)).alias("rows"), F.min(ARRIVED).alias("first_arrived"), F.max(ARRIVED).alias("last_arrived"))
    return took.select(
        F.lit(batch_id).alias("batch_id"), "rows", "first_arrived", "last_arrived", now.alias("committed_at"),
        since("first_arrived").alias("slowest_ms"), since("last_arrived").alias("fastest_ms"),
    )


def split_into_tables(
    stream: DataFrame, table: str, quarantine: str, latency: str, checkpoint: str, checks: list[Check] | None = None, live: bool = False
) -> StreamingQuery:
    """Each event once, good ones in ``table``, others in ``quarantine`` with
    ``reasons``, the rules that they fail; good and quarantined are all that
    landed. A row of ``latency`` for each batch says how long its rows took
    from landing (``replay_stream(..., arrival=True)``) to the commit.

    Nothing waits for a watermark, so events without a time or an id are kept.
    The three tables commit one by one, each with the batch's number: a batch
    that dies between them commits the missing ones when it runs again."""
    checks = STREAM_CHECKS if checks is None else checks

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, bad, times = (table_of(spark, n) for n in (table, quarantine, latency))
        rows = event_key(_plain(batch)).persist()  # files are read once
        fresh = rows.dropDuplicates(["_key"])
        try:
            dates = _touched(rows, "event_date")
            with _adaptive(spark):
                for t in (good, bad):  # less what earlier batches have put there
                    v = t.version()
                    held = t.in_partitions(dates, v) if v.number else ()
                    if held:
                        fresh = new_rows(t.read(held).where(F.col("_batch") < batch_id), fresh, ["_key"])
                fresh = fresh.withColumn("reasons", failing(fresh, checks)).withColumn("_batch", F.lit(batch_id)).persist()
                good.append(fresh.where("size(reasons) = 0").drop("reasons", ARRIVED), batch=batch_id, partition_by=("event_date",))
                bad.append(fresh.where("size(reasons) > 0").drop(ARRIVED), batch=batch_id, partition_by=("event_date",))
                times.append(_latency(rows, batch_id), batch=batch_id)
        finally:
            fresh.unpersist()
            rows.unpersist()

    return _run(stream.writeStream.foreachBatch(sink), checkpoint, live)


def weather_buckets(stream: DataFrame, table: str, checkpoint: str, minutes: int = 15, live: bool = False) -> StreamingQuery:
    """The weather feed per time bucket (readings, mean value)."""
    agg = (
        stream.withWatermark("ts", "1 hour")
        .groupBy(F.window("ts", f"{minutes} minutes"))
        .agg(F.count(F.lit(1)).alias("weather_readings"), F.avg("value").alias("weather_avg"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("bucket_start"), "weather_readings",
                F.round("weather_avg", 6).alias("weather_avg"))
        .withColumn("bucket_date", F.to_date("bucket_start"))
    )
    upsert = latest_upsert(table, ["bucket_start"], "bucket_date")
    return _run(agg.writeStream.outputMode("update").foreachBatch(upsert), checkpoint, live)


def telemetry_with_weather(stream: DataFrame, weather_table: str, table: str, checkpoint: str, minutes: int = 15,
                           live: bool = False) -> StreamingQuery:
    """Each telemetry event with the weather of its bucket (left join)."""
    weather = read_table_fresh(stream.sparkSession, weather_table).drop("_batch", "bucket_date")
    joined = stream.withColumn(
        "bucket_start", F.window("ts", f"{minutes} minutes").start.cast("timestamp_ntz")
    ).join(weather, "bucket_start", "left").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value",
        "bucket_start", "weather_readings", "weather_avg",
    )
    return _run(joined.writeStream.format("parquet").option("path", table).outputMode("append"), checkpoint, live)


def live_feeds(
    telemetry: DataFrame, weather: DataFrame, table: str, checkpoint: str, within: int = 600, delay: str = "1 hour",
    live: bool = False, state_partitions: int | None = None,
) -> StreamingQuery:
    """Both feeds as streams: each telemetry event with the newest weather
    reading of the ``within`` seconds up to it, none if there is none.

    Both feeds meet in time windows of twice ``within``, each of which holds the
    events of its second half and all readings that these can have. What a
    window holds is its state, evicted as the watermark (of both sides, a
    ``delay`` each) passes its end. In a window that a batch touches, each event
    takes the greatest reading time up to its own as the rows go by in order of
    time, so the work follows the rows and no pairs are made. A reading that
    arrives late takes the place of an older one: the table is upserted by
    event, in the event's date, the newest reading first."""
    span = F.expr(f"INTERVAL {within} SECONDS")
    side = weather.select(F.col("ts").alias("reading_ts"), F.col("value").alias("reading")).withWatermark("reading_ts", delay)
    events = event_key(telemetry.withWatermark("ts", delay))
    names = events.columns
    one, other = F.struct(*(F.col(f"`{c}`") for c in names)), F.struct("reading_ts", "reading")
    fast = events.select(F.col("ts").alias("at"), one.alias("event"))
    both = fast.unionByName(side.select(F.col("reading_ts").alias("at"), other.alias("newest")), allowMissingColumns=True)
    held = both.withColumn("slot", F.window("at", f"{2 * within} seconds", f"{within} seconds"))
    held = held.where(F.col("newest").isNotNull() | (F.col("at") >= F.col("slot.start") + span))
    slots = held.groupBy("slot").agg(F.collect_list(F.struct("at", "event", "newest")).alias("rows"))
    upsert = latest_upsert(table, ["_key", "event_date"], "event_date", ("reading_ts", "_batch"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("slot", F.explode("rows").alias("r")).select("slot", "r.*")
        w = Window.partitionBy("slot").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # the rows of a slot
        rows = rows.withColumn("newest", F.max("newest").over(w)).where("event IS NOT NULL")
        near = F.when(F.col("at") < F.col("newest.reading_ts") + span, F.col("newest"))
        rows = rows.select(*(F.col(f"event.`{c}`").alias(c) for c in names), near["reading_ts"].alias("reading_ts"), near["reading"].alias("reading"))
        rows = _plain(rows.where(~F.col("event_type").eqNullSafe(F.lit(END))))
        upsert(rows.withColumn("reading_ts", F.col("reading_ts").cast("timestamp_ntz")), batch_id)

    return _run(slots.writeStream.outputMode("update").foreachBatch(sink), checkpoint, live, state_partitions)


def read_table_fresh(spark: SparkSession, table: str) -> DataFrame:
    """The newest version of a table that a stream's micro-batches write."""
    return table_of(spark, table).read()


def scratch_tables(spark: SparkSession, name: str) -> tuple[str, str]:
    """(schema name, root folder) for a replay run's tables and checkpoints."""
    root = scratch_path(spark, name)
    schema = f"stream_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/tables'")
    return schema, root
