"""The checks that the quality reports must hold, written out for the oracle
(independent of the suites in ``operators/quality``): table, kind, column,
argument."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Expected:
    table: str
    kind: str
    column: str
    arg: object = ""


# What is checked.
SILVER = [
    Expected("race_data_circuits", "not_null", "circuitid"),
    Expected("race_data_circuits", "not_null", "country"),
    Expected("race_data_circuits", "in_set", "country", ["Australia", "Malaysia", "Bahrain", "Spain", "Monaco", "Turkey", "Canada", "United States", "France", "Germany", "Hungary", "Belgium", "Italy", "Singapore", "Japan", "China", "Brazil", "United Arab Emirates", "United Kingdom", "Argentina", "Mexico", "Portugal", "Morocco", "Netherlands", "Austria", "Sweden", "Switzerland", "South Africa", "South Korea", "India", "Russia", "Azerbaijan", "Saudi Arabia", "Qatar", "Vietnam"]),
    Expected("race_data_circuits", "absent", "url"),
    Expected("race_data_constructor_results", "not_null", "raceid"),
    Expected("race_data_constructor_results", "not_null", "constructorid"),
    Expected("race_data_constructor_results", "in_set", "status", ["Disqualified"]),
    Expected("race_data_constructor_results", "absent", "url"),
    Expected("race_data_constructor_standings", "not_null", "raceid"),
    Expected("race_data_constructor_standings", "not_null", "constructorid"),
    Expected("race_data_constructor_standings", "of_type", "position", "int"),
    Expected("race_data_constructor_standings", "not_match", "positiontext", r"^[RDENFW\-\\]$"),
    Expected("race_data_constructor_standings", "absent", "url"),
    Expected("race_data_constructors", "not_null", "constructorid"),
    Expected("race_data_constructors", "not_null", "name"),
    Expected("race_data_constructors", "absent", "url"),
    Expected("race_data_driver_standings", "not_null", "raceid"),
    Expected("race_data_driver_standings", "not_null", "driverid"),
    Expected("race_data_driver_standings", "of_type", "position", "int"),
    Expected("race_data_driver_standings", "not_match", "positiontext", r"^[RDENFW\-\\]$"),
    Expected("race_data_driver_standings", "absent", "url"),
    Expected("race_data_drivers", "not_null", "driverid"),
    Expected("race_data_drivers", "not_null", "forename"),
    Expected("race_data_drivers", "not_null", "surname"),
    Expected("race_data_drivers", "match", "forename", r"^\S.*\S$|^\S$"),
    Expected("race_data_drivers", "match", "surname", r"^\S.*\S$|^\S$"),
    Expected("race_data_drivers", "of_type", "number", "int"),
    Expected("race_data_drivers", "match", "dob", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_drivers", "absent", "url"),
    Expected("race_data_lap_times", "not_null", "raceid"),
    Expected("race_data_lap_times", "not_null", "driverid"),
    Expected("race_data_lap_times", "not_null", "lap"),
    Expected("race_data_lap_times", "between", "lap", [1, 100]),
    Expected("race_data_lap_times", "of_type", "milliseconds", "int"),
    Expected("race_data_lap_times", "not_null", "milliseconds"),
    Expected("race_data_lap_times", "absent", "url"),
    Expected("race_data_pit_stops", "not_null", "raceid"),
    Expected("race_data_pit_stops", "not_null", "driverid"),
    Expected("race_data_pit_stops", "not_null", "stop"),
    Expected("race_data_pit_stops", "not_null", "lap"),
    Expected("race_data_pit_stops", "of_type", "milliseconds", "int"),
    Expected("race_data_pit_stops", "absent", "url"),
    Expected("race_data_qualifying", "not_null", "raceid"),
    Expected("race_data_qualifying", "not_null", "driverid"),
    Expected("race_data_qualifying", "not_null", "constructorid"),
    Expected("race_data_qualifying", "of_type", "q1", "int"),
    Expected("race_data_qualifying", "of_type", "q2", "int"),
    Expected("race_data_qualifying", "of_type", "q3", "int"),
    Expected("race_data_qualifying", "absent", "url"),
    Expected("race_data_races", "not_null", "raceid"),
    Expected("race_data_races", "not_null", "date"),
    Expected("race_data_races", "not_null", "circuitid"),
    Expected("race_data_races", "match", "date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "match", "fp1_date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "match", "fp2_date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "match", "fp3_date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "match", "quali_date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "match", "sprint_date", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_data_races", "absent", "url"),
    Expected("race_data_races", "absent", "year"),
    Expected("race_data_results", "not_null", "resultid"),
    Expected("race_data_results", "not_null", "raceid"),
    Expected("race_data_results", "not_null", "driverid"),
    Expected("race_data_results", "not_null", "constructorid"),
    Expected("race_data_results", "between", "positionorder", [1, 40]),
    Expected("race_data_results", "of_type", "number", "int"),
    Expected("race_data_results", "of_type", "grid", "int"),
    Expected("race_data_results", "of_type", "position", "int"),
    Expected("race_data_results", "of_type", "rank", "int"),
    Expected("race_data_results", "of_type", "milliseconds", "int"),
    Expected("race_data_results", "not_match", "positiontext", r"^[RDENFW\-\\]$"),
    Expected("race_data_results", "of_type", "fastestlapspeed", "double"),
    Expected("race_data_results", "absent", "url"),
    Expected("race_data_seasons", "not_null", "year"),
    Expected("race_data_seasons", "match", "year", r"^\d{4}-01-01$"),
    Expected("race_data_seasons", "absent", "url"),
    Expected("race_data_sprint_results", "not_null", "raceid"),
    Expected("race_data_sprint_results", "not_null", "driverid"),
    Expected("race_data_sprint_results", "not_null", "constructorid"),
    Expected("race_data_sprint_results", "of_type", "position", "int"),
    Expected("race_data_sprint_results", "of_type", "milliseconds", "int"),
    Expected("race_data_sprint_results", "of_type", "rank", "int"),
    Expected("race_data_sprint_results", "not_match", "positiontext", r"^[RDENFW\-\\]$"),
    Expected("race_data_sprint_results", "absent", "url"),
    Expected("race_data_status", "not_null", "statusid"),
    Expected("race_data_status", "not_null", "status"),
    Expected("race_data_status", "absent", "url"),
    Expected("race_events_fatal_accidents_drivers", "not_null", "driver"),
    Expected("race_events_fatal_accidents_drivers", "match", "date_of_accident", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_events_fatal_accidents_drivers", "absent", "url"),
    Expected("race_events_fatal_accidents_marshalls", "not_null", "name"),
    Expected("race_events_fatal_accidents_marshalls", "match", "date_of_accident", r"^\d{4}-\d{2}-\d{2}$"),
    Expected("race_events_fatal_accidents_marshalls", "absent", "url"),
    Expected("race_events_red_flags", "not_null", "race"),
    Expected("race_events_red_flags", "in_set", "resumed", ["Resumed", "Standing Start", "Rolling Start", "Not Resumed"]),
    Expected("race_events_red_flags", "absent", "url"),
    Expected("race_events_safety_cars", "not_null", "race"),
    Expected("race_events_safety_cars", "not_null", "cause"),
    Expected("race_events_safety_cars", "not_null", "deployed"),
    Expected("race_events_safety_cars", "not_match", "cause", "(?i)accident[s/]|stranded car/"),
    Expected("race_events_safety_cars", "absent", "url"),
]

GOLD = [
    Expected("dim_circuits", "unique", "circuit_id"),
    Expected("dim_drivers", "unique", "driver_id"),
    Expected("dim_races", "unique", "race_id"),
    Expected("dim_races", "unique", "race_key"),
    Expected("dim_teams", "unique", "team_id"),
    Expected("standings_drivers", "unique", "race_id,driver_id"),
    Expected("standings_teams", "unique", "race_id,team_id"),
]

NAMES = {
    "not_null": "expect_not_null", "of_type": "expect_of_type", "in_set": "expect_in_set",
    "not_match": "expect_not_match_regex", "match": "expect_match_regex", "between": "expect_between",
    "absent": "expect_column_absent", "unique": "expect_unique",
}


def rule(e: Expected) -> str:
    quoted = lambda v: "'" + str(v).replace("'", "''") + "'"
    return {
        "not_null": lambda: f"{e.column} IS NOT NULL",
        "of_type": lambda: f"{e.column}: {e.arg}",
        "in_set": lambda: f"{e.column} IN ({', '.join(map(quoted, e.arg))})",
        "match": lambda: f"{e.column} RLIKE {e.arg}",
        "not_match": lambda: f"{e.column} NOT RLIKE {e.arg}",
        "between": lambda: f"{e.column} BETWEEN {e.arg[0]} AND {e.arg[1]}",
        "absent": lambda: f"no {e.column}",
        "unique": lambda: f"unique {e.column}",
    }[e.kind]()
