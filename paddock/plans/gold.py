"""Gold star schema: dimensions, facts, standings snapshots, event unions.

Each model is a function from Silver (or other Gold) DataFrames to a
DataFrame. ``GoldModels`` wires them to a source lookup and memoises
model references, the way a model DAG would, so a model used by several
others (``dim_races``) is one plan node that Spark can reuse.

Facts carry ``race_id`` next to ``race_key`` and join on the id: a
season with two races of one name would otherwise fan out or merge.
Dimension joins are inner equi-joins, broadcast up to
``spark.sql.autoBroadcastJoinThreshold``, or ``session.BROADCAST_ROWS``, and
else shuffled. A fact meets what it is shuffled for first, while its rows are
narrow, its race last, and after its last shuffle what is broadcast (so no
shuffle carries those columns): all that joins it by race, or by race and
something else (pit stops, standings, the race's circuit), is spread by the
race alone in the same width and needs no further shuffle of the fact. A race
that holds most of a fact is one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import not_classified_flag
from ..operators.features import session_intervals
from ..session import broadcasts, join_dimension, join_width, spread


def _full_name(first="forename", last="surname"):
    return F.concat(F.col(first), F.lit(" "), F.col(last))


# --- dimensions -------------------------------------------------------------


def dim_circuits(circuits: DataFrame) -> DataFrame:
    return circuits.select(
        F.col("circuitid").alias("circuit_id"),
        F.col("circuitref").alias("circuit_ref"),
        F.col("name").alias("circuit_name"),
        F.col("location").alias("city"),
        F.col("country"),
        F.col("lat").alias("latitude"),
        F.col("lng").alias("longitude"),
        F.col("alt").alias("altitude_meters"),
    )


def dim_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.select(
        F.col("driverid").alias("driver_id"),
        F.col("driverref").alias("driver_ref"),
        F.col("number").alias("driver_number"),
        F.col("code").alias("driver_code"),
        F.col("forename").alias("first_name"),
        F.col("surname").alias("last_name"),
        _full_name().alias("driver_full_name"),
        F.col("dob").alias("date_of_birth"),
        F.col("nationality"),
    )


def race_key(date_col="date", name_col="name"):
    """Season year + ``_`` + name with blanks as underscores."""
    return F.concat(F.year(date_col).cast("string"), F.lit("_"), F.replace(F.col(name_col), F.lit(" "), F.lit("_")))


def dim_races(races: DataFrame) -> DataFrame:
    sessions = ["fp1", "fp2", "fp3", "quali", "sprint"]
    return races.select(
        F.col("raceid").alias("race_id"),
        race_key().alias("race_key"),
        F.year("date").alias("year"),
        F.col("name").alias("race_name"),
        F.col("round"),
        F.col("date").alias("race_date"),
        F.col("time").alias("race_time"),
        F.col("circuitid").alias("circuit_id"),
        *[F.col(f"{s}_{part}") for s in sessions for part in ("date", "time")],
    )


def dim_teams(constructors: DataFrame) -> DataFrame:
    return constructors.select(
        F.col("constructorid").alias("team_id"),
        F.col("constructorref").alias("team_ref"),
        F.col("name").alias("team_name"),
        F.col("nationality"),
    )


# --- facts ------------------------------------------------------------------


def _race_side(races_dim: DataFrame) -> DataFrame:
    return races_dim.select("race_id", "race_key", "year")


def _driver_side(drivers: DataFrame) -> DataFrame:
    return drivers.select(F.col("driverid").alias("d_driverid"), _full_name().alias("driver_full_name"))


def _team_side(constructors: DataFrame) -> DataFrame:
    return constructors.select(F.col("constructorid").alias("t_constructorid"), F.col("name").alias("team_name"))


def _status_side(status: DataFrame) -> DataFrame:
    return status.select(F.col("statusid").alias("s_statusid"), F.col("status"))


#: a dimension that joins a fact: its rows, the fact's column, its own
Side = tuple[DataFrame, str, str]


def _driver(drivers: DataFrame) -> Side:
    return _driver_side(drivers), "driverid", "d_driverid"


def _team(constructors: DataFrame) -> Side:
    return _team_side(constructors), "constructorid", "t_constructorid"


def _status(status: DataFrame) -> Side:
    return _status_side(status), "statusid", "s_statusid"


def _by_race(df: DataFrame, races_dim: DataFrame, width: int, *sides: Side) -> tuple[DataFrame, list[Side]]:
    """The fact with the sides that it is shuffled for and with its race, by
    which its rows stay spread, and the sides that are left to broadcast
    (``_attach``). Sides of one key in turn need one shuffle of the fact."""
    left, at = [], None
    for side, key, its in sides:
        if width and broadcasts(side):
            left.append((side, key, its))
        else:
            df, at = join_dimension(df, side, key, its, width, placed=key == at), key
    return spread(df, width, "raceid").join(spread(_race_side(races_dim), width, "race_id"), F.col("raceid") == F.col("race_id")), left


def _attach(df: DataFrame, sides: list[Side], together: str | None = None) -> DataFrame:
    """Broadcast joins after the last shuffle, which puts the rows of one value
    of ``together`` into few tasks."""
    df = df.hint("rebalance", together) if together else df
    for side, key, its in sides:
        df = df.join(F.broadcast(side), F.col(key) == F.col(its))
    return df


def fact_lap_times(lap_times: DataFrame, races_dim: DataFrame, drivers: DataFrame, width: int = 0, together: str | None = None) -> DataFrame:
    return _attach(*_by_race(lap_times, races_dim, width, _driver(drivers)), together).select(
        "race_key",
        "year",
        "driver_full_name",
        F.col("driverid").alias("driver_id"),
        "lap",
        F.col("position").alias("lap_position"),
        F.col("milliseconds").alias("lap_time_ms"),
        "race_id",
    )


def fact_pit_stops(pit_stops: DataFrame, races_dim: DataFrame, drivers: DataFrame, width: int = 0, together: str | None = None) -> DataFrame:
    return _attach(*_by_race(pit_stops, races_dim, width, _driver(drivers)), together).select(
        "race_key",
        "year",
        "driver_full_name",
        F.col("driverid").alias("driver_id"),
        F.col("stop").alias("stop_number"),
        "lap",
        F.col("duration").alias("duration_ms"),
        "race_id",
    )


def fact_qualifying(
    qualifying: DataFrame, races_dim: DataFrame, drivers: DataFrame, constructors: DataFrame, width: int = 0, together: str | None = None
) -> DataFrame:
    j = _by_race(qualifying, races_dim, width, _driver(drivers), _team(constructors))
    return _attach(*j, together).select(
        "race_key",
        "year",
        "driver_full_name",
        F.col("driverid").alias("driver_id"),
        "team_name",
        F.col("constructorid").alias("team_id"),
        F.col("number").alias("car_number"),
        F.col("position").alias("qualifying_position"),
        F.col("q1").alias("q1_ms"),
        F.col("q2").alias("q2_ms"),
        F.col("q3").alias("q3_ms"),
        "race_id",
    )


def pit_aggregates(pit_facts: DataFrame) -> DataFrame:
    """Stops and total stop time per race and driver (partial aggregate
    per task before the shuffle, so a hot key costs one row per task)."""
    return pit_facts.groupBy("race_id", "driver_id").agg(
        F.count(F.lit(1)).alias("pit_stop_count"), F.sum("duration_ms").alias("total_pit_time_ms")
    )


def pit_aggregates_eager(pit_stops: DataFrame, races_dim: DataFrame, drivers: DataFrame, width: int = 0) -> DataFrame:
    """``pit_aggregates(fact_pit_stops(...))`` with the aggregation pushed
    below the join of the races.

    Stops take the number of their driver's rows, go by race (one shuffle of
    three columns and that number) and are grouped per (race, driver); counts
    and sums are scaled by the multiplicities of driver and race. The numbers
    equal joining first and aggregating after for any key multiplicity. The
    rows stay spread by race.
    """
    drivers_n = drivers.groupBy(F.col("driverid").alias("_did")).agg(F.count(F.lit(1)).alias("_dn"))
    stops = pit_stops.select(F.col("raceid").alias("race_id"), F.col("driverid").alias("driver_id"), "duration")
    races = spread(races_dim.select(F.col("race_id").alias("_rid")), width, "_rid").groupBy("_rid").agg(F.count(F.lit(1)).alias("_rn"))
    by_key = lambda df, n, ms: df.groupBy("race_id", "driver_id").agg(n.alias("_n"), ms.alias("_ms"))
    if width and broadcasts(drivers):
        per_key = by_key(spread(stops, width, "race_id"), F.count(F.lit(1)), F.sum("duration"))
        per_key = per_key.join(F.broadcast(drivers_n), F.col("driver_id") == F.col("_did"))
        per_key = per_key.withColumns({c: F.col(c) * F.col("_dn") for c in ("_n", "_ms")})
    else:
        stops = spread(join_dimension(stops, drivers_n, "driver_id", "_did", width), width, "race_id")
        per_key = by_key(stops, F.sum("_dn"), F.sum(F.col("duration") * F.col("_dn")))
    j = per_key.join(races, F.col("race_id") == F.col("_rid"))
    return j.select(
        "race_id", "driver_id",
        (F.col("_n") * F.col("_rn")).alias("pit_stop_count"),
        (F.col("_ms") * F.col("_rn")).alias("total_pit_time_ms"),
    )


def _results_core(results: DataFrame, races_dim, drivers, constructors, status, width: int = 0, d=None, t=None) -> tuple[DataFrame, list[Side]]:
    """``_by_race`` with the dimensions from the narrowest on; ``d`` and ``t``
    (``driver_dimension``, ``team_dimension``) right after the driver and the
    team, where the rows already are by that key."""
    sides = [_driver(drivers), *([(d, "driverid", "d_driver_id")] if d is not None else []), _team(constructors), *([(t, "constructorid", "t_team_id")] if t is not None else [])]
    j = results.withColumn("dnf_flag", not_classified_flag("positiontext")).drop("positiontext")
    if width and broadcasts(status):
        return _by_race(j, races_dim, width, *sides, _status(status))
    return _by_race(j.join(_status_side(status), F.col("statusid") == F.col("s_statusid")), races_dim, width, *sides)


def driver_dimension(dim: DataFrame) -> DataFrame:
    return dim.select(*(F.col(c).alias(f"d_{c}") for c in ("driver_id", "driver_code", "nationality", "date_of_birth")))


def team_dimension(dim: DataFrame) -> DataFrame:
    return dim.select(F.col("team_id").alias("t_team_id"), F.col("nationality").alias("t_nationality"))


def results_by_race(
    results: DataFrame,
    races_dim: DataFrame,
    drivers: DataFrame,
    constructors: DataFrame,
    status: DataFrame,
    pit_stops: DataFrame,
    width: int = 0,
    d: DataFrame | None = None,
    t: DataFrame | None = None,
) -> tuple[DataFrame, list[Side]]:
    """Results by race with their stops, without the sides that are left to
    broadcast. ``pit_stops`` are the Silver stops; their per-(race, driver)
    aggregates equal those of the ``fact_pit_stops`` model (see
    ``pit_aggregates_eager``)."""
    pa = pit_aggregates_eager(pit_stops, races_dim, drivers, width).withColumnsRenamed(
        {"race_id": "pa_race_id", "driver_id": "pa_driver_id"}
    )
    j, sides = _results_core(results, races_dim, drivers, constructors, status, width, d, t)
    return j.join(pa, (F.col("race_id") == F.col("pa_race_id")) & (F.col("driverid") == F.col("pa_driver_id")), "left"), sides


#: columns of ``fact_results`` and what they are in ``results_by_race`` with its sides
RESULTS_COLUMNS = {
    "race_key": "race_key",
    "year": "year",
    "driver_full_name": "driver_full_name",
    "driver_id": "driverid",
    "team_name": "team_name",
    "team_id": "constructorid",
    "car_number": "number",
    "grid_position": "grid",
    "finish_position": "position",
    "position_order": "positionorder",
    "points": "points",
    "laps": "laps",
    "race_time_ms": "milliseconds",
    "fastest_lap_number": "fastestlap",
    "fastest_lap_rank": "rank",
    "fastest_lap_speed": "fastestlapspeed",
    "status": "status",
    "dnf_flag": "dnf_flag",
    "positions_gained": "grid - positionorder",
    "pit_stop_count": "coalesce(pit_stop_count, 0)",
    "total_pit_time_ms": "coalesce(total_pit_time_ms, 0)",
    "race_id": "race_id",
}


def fact_results(
    results: DataFrame,
    races_dim: DataFrame,
    drivers: DataFrame,
    constructors: DataFrame,
    status: DataFrame,
    pit_stops: DataFrame,
    width: int = 0,
    together: str | None = None,
) -> DataFrame:
    """``results_by_race`` with all its sides."""
    j = _attach(*results_by_race(results, races_dim, drivers, constructors, status, pit_stops, width), together)
    return j.select(*(F.expr(src).alias(name) for name, src in RESULTS_COLUMNS.items()))


def fact_sprint_results(
    sprint: DataFrame,
    races_dim: DataFrame,
    drivers: DataFrame,
    constructors: DataFrame,
    status: DataFrame,
    width: int = 0,
    together: str | None = None,
) -> DataFrame:
    return _attach(*_results_core(sprint, races_dim, drivers, constructors, status, width), together).select(
        "race_key",
        "year",
        "driver_full_name",
        F.col("driverid").alias("driver_id"),
        "team_name",
        F.col("constructorid").alias("team_id"),
        F.col("number").alias("car_number"),
        F.col("grid").alias("grid_position"),
        F.col("position").alias("finish_position"),
        F.col("positionorder").alias("position_order"),
        "points",
        "laps",
        F.col("milliseconds").alias("race_time_ms"),
        F.col("fastestlap").alias("fastest_lap_number"),
        F.col("fastestlaptime").alias("fastest_lap_time_ms"),
        "status",
        "dnf_flag",
        (F.col("grid") - F.col("positionorder")).alias("positions_gained"),
        "race_id",
    )


def standings_drivers(ds: DataFrame, races_dim: DataFrame, drivers: DataFrame, width: int = 0) -> DataFrame:
    return _attach(*_by_race(ds, races_dim, width, _driver(drivers))).select(
        "race_key",
        "year",
        "driver_full_name",
        F.col("driverid").alias("driver_id"),
        "points",
        "position",
        "wins",
        "race_id",
    )


def standings_teams(cs: DataFrame, races_dim: DataFrame, constructors: DataFrame, width: int = 0) -> DataFrame:
    return _attach(*_by_race(cs, races_dim, width, _team(constructors))).select(
        "race_key",
        "year",
        "team_name",
        F.col("constructorid").alias("team_id"),
        "points",
        "position",
        "wins",
        "race_id",
    )


# --- event unions -----------------------------------------------------------


def _null(t: str):
    return F.lit(None).cast(t)


def event_race_incidents(safety_cars: DataFrame, red_flags: DataFrame) -> DataFrame:
    sc = safety_cars.select(
        F.col("race").alias("race_name"),
        F.lit("Safety Car").alias("incident_type"),
        _null("int").alias("lap"),
        F.col("cause").alias("incident"),
        F.col("deployed").alias("deployed_lap"),
        F.col("retreated").cast("double").alias("retreated_lap"),
        F.col("fulllaps").alias("full_laps_under_sc"),
        _null("string").alias("resumed"),
        _null("string").alias("excluded"),
    )
    rf = red_flags.select(
        F.col("race").alias("race_name"),
        F.lit("Red Flag").alias("incident_type"),
        F.col("lap"),
        F.col("incident"),
        _null("int").alias("deployed_lap"),
        _null("double").alias("retreated_lap"),
        _null("int").alias("full_laps_under_sc"),
        F.col("resumed"),
        F.col("excluded"),
    )
    return sc.unionByName(rf)


def event_fatal_accidents(drivers_acc: DataFrame, marshals: DataFrame) -> DataFrame:
    d = drivers_acc.select(
        F.col("driver").alias("name"),
        "age",
        "date_of_accident",
        "event",
        "car",
        "session",
        F.lit("Driver").alias("type"),
    )
    m = marshals.select(
        "name",
        "age",
        "date_of_accident",
        "event",
        _null("string").alias("car"),
        _null("string").alias("session"),
        F.lit("Marshal").alias("type"),
    )
    return d.unionByName(m)


def dim_sessions(races: DataFrame) -> DataFrame:
    """one row a session of a race weekend that has a date and a time:
    race_id, session, starts, ends as timestamps."""
    return session_intervals(races).withColumnRenamed("raceid", "race_id")


# --- wiring -----------------------------------------------------------------


class GoldModels:
    """Resolve model references against a Silver source lookup, once each."""

    def __init__(
        self,
        source: Callable[[str], DataFrame],
        materialized: Callable[[str], DataFrame] | None = None,
        together: str | None = None,
    ):
        """``materialized`` resolves a model to an already written table
        (e.g. ``spark.table``) instead of rebuilding it. The facts' rows of one
        value of the column ``together`` are in few tasks."""
        self.source = source
        self.materialized = materialized
        self.together = together
        self._refs: dict[str, DataFrame] = {}
        self._widths: dict[str, int] = {}

    def width(self, name: str = "race_data_results") -> int:
        """Tasks for the joins of a source's rows (``join_width``)."""
        if name not in self._widths:
            self._widths[name] = join_width(self.ref("fact_results") if self.materialized is not None else self.source(name))
        return self._widths[name]

    def results_with_dimensions(self) -> tuple[DataFrame, list[Side]]:
        """``fact_results`` by race with the columns of its driver (``d_*``) and
        team (``t_*``), but for those of the sides that are left to broadcast."""
        d, t = driver_dimension(self.ref("dim_drivers")), team_dimension(self.ref("dim_teams"))
        if self.materialized is None and "fact_results" not in self._refs:
            j, left = self._results_by_race(d, t)
            there = [c for c in j.columns if c.startswith(("d_", "t_"))] + [key for _, key, _ in left]
            late = {c for side, _, _ in left for c in side.columns}
            return j.select(*(F.expr(src).alias(name) for name, src in RESULTS_COLUMNS.items() if src not in late), *dict.fromkeys(there)), left
        fr, left = self.ref("fact_results"), []
        for side, key, its in ((d, "driver_id", "d_driver_id"), (t, "team_id", "t_team_id")):
            if self.width() and broadcasts(side):
                left.append((side, key, its))
            else:
                fr = join_dimension(fr, side, key, its, self.width())
        return spread(fr, self.width(), "race_id"), left

    def ref(self, name: str) -> DataFrame:
        if name not in self._refs:
            if self.materialized is not None:
                self._refs[name] = self.materialized(name)
            else:
                self._refs[name] = getattr(self, f"_build_{name}")()
        return self._refs[name]

    __getitem__ = ref

    def use(self, name: str, df: DataFrame) -> None:
        """Resolve ``name`` to ``df`` (a written table) from now on."""
        self._refs[name] = df

    def _build_dim_circuits(self):
        return dim_circuits(self.source("race_data_circuits"))

    def _build_dim_drivers(self):
        return dim_drivers(self.source("race_data_drivers"))

    def _build_dim_races(self):
        return dim_races(self.source("race_data_races"))

    def _build_dim_sessions(self):
        return dim_sessions(self.source("race_data_races"))

    def _build_dim_teams(self):
        return dim_teams(self.source("race_data_constructors"))

    def _build_fact_lap_times(self):
        return fact_lap_times(self.source("race_data_lap_times"), self.ref("dim_races"), self.source("race_data_drivers"), self.width("race_data_lap_times"), self.together)

    def _build_fact_pit_stops(self):
        return fact_pit_stops(self.source("race_data_pit_stops"), self.ref("dim_races"), self.source("race_data_drivers"), self.width("race_data_pit_stops"), self.together)

    def _build_fact_qualifying(self):
        return fact_qualifying(
            self.source("race_data_qualifying"),
            self.ref("dim_races"),
            self.source("race_data_drivers"),
            self.source("race_data_constructors"),
            self.width("race_data_qualifying"),
            self.together,
        )

    def _results_sources(self):
        tables = ("race_data_drivers", "race_data_constructors", "race_data_status", "race_data_pit_stops")
        return self.source("race_data_results"), self.ref("dim_races"), *(self.source(t) for t in tables), self.width()

    def _results_by_race(self, d, t):
        return results_by_race(*self._results_sources(), d, t)

    def _build_fact_results(self):
        return fact_results(*self._results_sources(), self.together)

    def _build_fact_sprint_results(self):
        return fact_sprint_results(
            self.source("race_data_sprint_results"),
            self.ref("dim_races"),
            self.source("race_data_drivers"),
            self.source("race_data_constructors"),
            self.source("race_data_status"),
            self.width("race_data_sprint_results"),
            self.together,
        )

    def _build_standings_drivers(self):
        return standings_drivers(
            self.source("race_data_driver_standings"), self.ref("dim_races"), self.source("race_data_drivers"), self.width()
        )

    def _build_standings_teams(self):
        return standings_teams(
            self.source("race_data_constructor_standings"), self.ref("dim_races"), self.source("race_data_constructors"), self.width()
        )

    def _build_event_race_incidents(self):
        return event_race_incidents(self.source("race_events_safety_cars"), self.source("race_events_red_flags"))

    def _build_event_fatal_accidents(self):
        return event_fatal_accidents(
            self.source("race_events_fatal_accidents_drivers"), self.source("race_events_fatal_accidents_marshalls")
        )


GOLD_MODELS = (
    "dim_circuits",
    "dim_drivers",
    "dim_races",
    "dim_sessions",
    "dim_teams",
    "fact_lap_times",
    "fact_pit_stops",
    "fact_qualifying",
    "fact_results",
    "fact_sprint_results",
    "standings_drivers",
    "standings_teams",
    "event_race_incidents",
    "event_fatal_accidents",
)
