"""Driver/team features over the Gold facts (M3-M8).

Every feature first aggregates to a small grain (driver x season,
team x race, race x driver) with map-side partial aggregation, so hot
keys are reduced inside each task before any shuffle; windows then run
over those aggregated series. The season window is bounded by the number
of seasons per driver; the race-by-race team window uses the skew-safe
``trailing_mean`` because a team's race series grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import session_timestamp
from .sequence import trailing_mean

#: sessions of a race weekend, the Silver columns of their start, and their length in minutes
SESSIONS = (
    ("race", "date", "time", 120), ("fp1", "fp1_date", "fp1_time", 60), ("fp2", "fp2_date", "fp2_time", 60),
    ("fp3", "fp3_date", "fp3_time", 60), ("quali", "quali_date", "quali_time", 60), ("sprint", "sprint_date", "sprint_time", 60),
)


def driver_seasons(results: DataFrame) -> DataFrame:
    """One row per driver and season: races, points, DNFs."""
    return results.groupBy("driver_id", "year").agg(
        F.count(F.lit(1)).alias("races"),
        F.sum("points").alias("points"),
        F.count_if("dnf_flag").alias("dnfs"),
    )


def trailing_season_average(results: DataFrame, seasons: int = 3) -> DataFrame:
    """Average points per race over the previous ``seasons`` seasons."""
    ds = driver_seasons(results)
    w = Window.partitionBy("driver_id").orderBy("year").rangeBetween(-seasons, -1)
    return ds.select(
        "driver_id", "year", "races", "points",
        (F.sum("points").over(w) / F.sum("races").over(w)).alias("trailing_avg_points"),
    )


def dnf_rate(results: DataFrame) -> DataFrame:
    """M4: share of results not classified, per driver."""
    return results.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("results"),
        F.avg(F.col("dnf_flag").cast("int")).alias("dnf_rate"),
    )


def pace_delta(qualifying: DataFrame, results: DataFrame) -> DataFrame:
    """M5: qualifying position minus finishing order, per driver.

    Both sides are reduced to one row per (race, driver) before the join,
    so a duplicated key cannot fan out into all pairs.
    """
    q = qualifying.groupBy("race_id", "driver_id").agg(F.avg("qualifying_position").alias("q_pos"))
    r = results.groupBy("race_id", "driver_id").agg(F.avg("position_order").alias("r_pos"))
    j = q.join(r, ["race_id", "driver_id"])
    return j.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("races"),
        F.round(F.avg(F.col("q_pos") - F.col("r_pos")), 6).alias("pace_delta"),
    )


def consistency(results: DataFrame) -> DataFrame:
    """M7: population variance of the finishing order, per driver."""
    return results.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("results"),
        F.round(F.var_pop("position_order"), 6).alias("position_variance"),
    )


def team_momentum(results: DataFrame, races_dim: DataFrame, last: int = 4, width: int = 0) -> DataFrame:
    """A team's average points over its previous ``last`` races, in
    ``width`` tasks (0: the session's)."""
    per_race = results.groupBy("team_id", "race_id").agg(F.sum("points").alias("team_points"))
    dated = per_race.join(races_dim.select("race_id", "race_date"), "race_id")
    out = trailing_mean(dated, "team_id", ["race_date", "race_id"], "team_points", last, "momentum", width or None)
    return out.select("team_id", "race_id", "race_date", "team_points", "momentum")


def session_weather(
    events: DataFrame, weather_types=("purchase",), since: str | None = None
) -> DataFrame:
    """M8: per session day, telemetry volume (all events but weather) left-joined with the weather
    feed aggregated to the same day; ``since`` keeps sessions from that
    date on (the filter is pushed into the scan)."""
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since).cast("date"))
    day = F.to_date("ts").alias("session_date")
    telemetry = events.where(~F.coalesce(F.col("event_type").isin(*weather_types), F.lit(False))).groupBy(day).agg(
        F.count(F.lit(1)).alias("telemetry_events")
    )
    weather = events.where(F.col("event_type").isin(*weather_types)).groupBy(day).agg(
        F.count(F.lit(1)).alias("weather_readings"), F.round(F.avg("value"), 6).alias("avg_weather")
    )
    return telemetry.join(weather, "session_date", "left")


def session_intervals(races: DataFrame, since: str | None = None) -> DataFrame:
    """raceid, session, starts, ends of each session of the Silver races
    that has a date and a time, from the date ``since`` on."""
    kinds = [
        F.struct(F.lit(name).alias("session"), session_timestamp(d, t).alias("starts"), F.lit(m).alias("minutes")) for name, d, t, m in SESSIONS
    ]
    rows = races.select("raceid", F.explode(F.array(*kinds)).alias("s")).select("raceid", "s.*").where("starts IS NOT NULL")
    if since is not None:
        rows = rows.where(F.col("starts") >= F.lit(since).cast("date"))
    return rows.select("raceid", "session", "starts", (F.col("starts") + F.make_dt_interval(mins=F.col("minutes"))).alias("ends"))


def weather_in_sessions(sessions: DataFrame, readings: DataFrame, slot_minutes: int = 15) -> DataFrame:
    """M8: each session (any columns, with starts and ends) with the number and
    mean of the readings (ts, value) of starts <= ts < ends; 0 and NULL without any.

    An interval join without a cartesian product: time is cut into slots. Slots
    that lie inside a session are joined as one sum a slot, whatever the number
    of readings in it; only the slots of a session's two edges meet readings one
    by one, under the exact bound. Equal intervals are joined once, and equal
    times of a slot are summed before. Readings without a time are in no session."""
    size = slot_minutes * 60 * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    intervals = sessions.select("starts", "ends").where("starts < ends").distinct().select("starts", "ends", micros("starts").alias("lo"), micros("ends").alias("hi"))
    timed = readings.where("ts IS NOT NULL").select(micros("ts").alias("at"), "value")
    timed = timed.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("k"), F.sum("value").alias("v"))
    slot = lambda x: f"({x} - pmod({x}, {size}L)) div {size}L"
    timed = timed.withColumn("slot", F.expr(slot("at")))
    whole = timed.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("v").alias("v"))
    cut = intervals.withColumns({"first": F.expr(slot(f"(lo + {size - 1}L)")), "last": F.expr(f"{slot('hi')} - 1")})
    inner = cut.where("first <= last").select("lo", "hi", F.explode(F.sequence("first", "last")).alias("slot")).join(whole, "slot").select("lo", "hi", "n", "k", "v")
    # the parts before the first and after the last whole slot, or all of a session within one or two
    left = F.struct(F.col("lo").alias("a"), F.least("hi", F.col("first") * size).alias("b"))
    right = F.struct(F.greatest(F.least("hi", F.col("first") * size), (F.col("last") + 1) * size).alias("a"), F.col("hi").alias("b"))
    edges = cut.select("lo", "hi", F.explode(F.array(left, right)).alias("e")).select("lo", "hi", "e.*").where("a < b").withColumn("slot", F.expr(slot("a")))
    outer = edges.join(timed, "slot").where("at >= a AND at < b").select("lo", "hi", "n", "k", "v")
    found = inner.unionByName(outer).groupBy("lo", "hi").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("v").alias("v"))
    named = intervals.join(found, ["lo", "hi"]).select(
        F.col("starts").alias("_starts"), F.col("ends").alias("_ends"), F.col("n").alias("_n"), F.round(F.col("v") / F.nullif(F.col("k"), F.lit(0)), 6).alias("_mean")
    )
    out = sessions.join(named, (F.col("starts") == F.col("_starts")) & (F.col("ends") == F.col("_ends")), "left")
    return out.select(*sessions.columns, F.coalesce("_n", F.lit(0)).alias("weather_readings"), F.col("_mean").alias("avg_weather"))
