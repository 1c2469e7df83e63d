"""Declared Bronze schemas for the race-data source files.

Field order is the column order of the public race-data CSV files, so a
header CSV can be read with ``schema=`` and no inference pass (columns are
matched by header name; this order is that of the resulting table). Columns
that may hold the ``\\N`` sentinel or formatted times stay strings in
Bronze; the Silver rules cast them. Names are as in the files; ingest
sanitises them (lower case, blanks to ``_``).
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

S, I, D, L = StringType(), IntegerType(), DoubleType(), LongType()


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


#: ending of the table that holds the records of a file that don't fit
QUARANTINE = "__quarantine"

# Source file columns, in file order, with their Bronze types.
BRONZE_SCHEMAS: dict[str, StructType] = {
    "race_data_circuits": _schema(
        ("circuitId", L), ("circuitRef", S), ("name", S), ("location", S), ("country", S),
        ("lat", D), ("lng", D), ("alt", I), ("url", S),
    ),
    "race_data_constructors": _schema(
        ("constructorId", L), ("constructorRef", S), ("name", S), ("nationality", S), ("url", S),
    ),
    "race_data_drivers": _schema(
        ("driverId", L), ("driverRef", S), ("number", S), ("code", S), ("forename", S), ("surname", S),
        ("dob", S), ("nationality", S), ("url", S),
    ),
    "race_data_races": _schema(
        ("raceId", L), ("year", I), ("round", I), ("circuitId", L), ("name", S), ("date", S), ("time", S),
        ("url", S), ("fp1_date", S), ("fp1_time", S), ("fp2_date", S), ("fp2_time", S), ("fp3_date", S),
        ("fp3_time", S), ("quali_date", S), ("quali_time", S), ("sprint_date", S), ("sprint_time", S),
    ),
    "race_data_results": _schema(
        ("resultId", L), ("raceId", L), ("driverId", L), ("constructorId", L), ("number", S), ("grid", S),
        ("position", S), ("positionText", S), ("positionOrder", I), ("points", D), ("laps", I), ("time", S),
        ("milliseconds", S), ("fastestLap", S), ("rank", S), ("fastestLapTime", S), ("fastestLapSpeed", S),
        ("statusId", I),
    ),
    "race_data_sprint_results": _schema(
        ("resultId", L), ("raceId", L), ("driverId", L), ("constructorId", L), ("number", S), ("grid", S),
        ("position", S), ("positionText", S), ("positionOrder", I), ("points", D), ("laps", I), ("time", S),
        ("milliseconds", S), ("fastestLap", S), ("rank", S), ("fastestLapTime", S), ("statusId", I),
    ),
    "race_data_qualifying": _schema(
        ("qualifyId", L), ("raceId", L), ("driverId", L), ("constructorId", L), ("number", S),
        ("position", S), ("q1", S), ("q2", S), ("q3", S),
    ),
    "race_data_lap_times": _schema(
        ("raceId", L), ("driverId", L), ("lap", I), ("position", S), ("time", S), ("milliseconds", S),
    ),
    "race_data_pit_stops": _schema(
        ("raceId", L), ("driverId", L), ("stop", I), ("lap", I), ("time", S), ("duration", S),
        ("milliseconds", S),
    ),
    "race_data_driver_standings": _schema(
        ("driverStandingsId", L), ("raceId", L), ("driverId", L), ("points", D), ("position", S),
        ("positionText", S), ("wins", I),
    ),
    "race_data_constructor_standings": _schema(
        ("constructorStandingsId", L), ("raceId", L), ("constructorId", L), ("points", D), ("position", S),
        ("positionText", S), ("wins", I),
    ),
    "race_data_constructor_results": _schema(
        ("constructorResultsId", L), ("raceId", L), ("constructorId", L), ("points", D), ("status", S),
    ),
    "race_data_seasons": _schema(("year", I), ("url", S)),
    "race_data_status": _schema(("statusId", I), ("status", S)),
    "race_events_safety_cars": _schema(
        ("Race", S), ("Cause", S), ("Deployed", I), ("Retreated", D), ("FullLaps", I),
    ),
    "race_events_red_flags": _schema(
        ("Race", S), ("Lap", I), ("Incident", S), ("Resumed", S), ("Excluded", S),
    ),
    "race_events_fatal_accidents_drivers": _schema(
        ("Driver", S), ("Age", I), ("Date Of Accident", S), ("Event", S), ("Car", S), ("Session", S),
    ),
    "race_events_fatal_accidents_marshalls": _schema(
        ("Name", S), ("Age", I), ("Date Of Accident", S), ("Event", S),
    ),
}
