"""Bronze -> Silver cleaning.

General rules run on every table, in this order (trim before map, map
before cast): drop ``url``, trim strings, whole-value map, multi-format
date cast, safe int cast. Table-specific rules follow via a name ->
function map; an unknown table passes through.

Each rule is a single ``select`` over the current schema, so a chain of
rules collapses into one Project and never leaves codegen. Rules look at
column names and types only (driver-side metadata), never at data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from ..functions._col import ident
from ..functions.text import (
    RACE_DATA_VALUE_MAP,
    RACE_EVENTS_VALUE_MAP,
    map_values_sql,
    normalise_cause_sql,
)
from ..functions.timefmt import (
    DEFAULT_CENTURY_PIVOT,
    clean_wall_clock_sql,
    parse_multi_format_date_sql,
    season_start_sql,
    time_to_ms_sql,
)

# Columns read as integers by name ("year" left out on purpose).
INT_CAST_COLUMNS = ("milliseconds", "position", "number", "grid", "rank")
# Substrings marking a date column.
DATE_NAME_MARKERS = ("date", "dob")
# Wall-clock columns of the races table.
RACE_CLOCK_COLUMNS = ("time", "fp1_time", "fp2_time", "fp3_time", "quali_time", "sprint_time")
# Fixed value: prefix of the race-events table family.
EVENTS_PREFIX = "race_events_"


def _rewrite(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Replace the named columns in place with one select; each rule is
    SQL expression text over the current columns (one JVM call per rule)."""
    if not rules:
        return df
    return df.selectExpr(*[f"{rules[c]} AS {ident(c)}" if c in rules else ident(c) for c in df.columns])


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def drop_url(df: DataFrame) -> DataFrame:
    return df.drop("url")


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim blanks (not tabs) off every string column."""
    return _rewrite(df, {c: f"trim({ident(c)})" for c in _string_columns(df)})


def map_string_values(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """Whole-value map on string columns; the map depends on the table family."""
    mapping = RACE_EVENTS_VALUE_MAP if table_name.startswith(EVENTS_PREFIX) else RACE_DATA_VALUE_MAP
    targets = _string_columns(df) if columns is None else columns
    return _rewrite(df, {c: map_values_sql(ident(c), mapping) for c in targets})


def cast_date_columns(df: DataFrame, century_pivot: str = DEFAULT_CENTURY_PIVOT) -> DataFrame:
    rules = {
        c: parse_multi_format_date_sql(ident(c), century_pivot)
        for c in df.columns
        if any(m in c for m in DATE_NAME_MARKERS)
    }
    return _rewrite(df, rules)


def cast_int_columns(df: DataFrame) -> DataFrame:
    return _rewrite(df, {c: f"try_cast({ident(c)} AS INT)" for c in INT_CAST_COLUMNS if c in df.columns})


def apply_general_rules(df: DataFrame, table_name: str, century_pivot: str = DEFAULT_CENTURY_PIVOT) -> DataFrame:
    return (
        df.transform(drop_url)
        .transform(trim_strings)
        .transform(lambda d: map_string_values(d, table_name))
        .transform(lambda d: cast_date_columns(d, century_pivot))
        .transform(cast_int_columns)
    )


# --- table-specific rules -------------------------------------------------


def races_rules(df: DataFrame) -> DataFrame:
    df = df.drop("year")
    return _rewrite(df, {c: clean_wall_clock_sql(ident(c)) for c in RACE_CLOCK_COLUMNS if c in df.columns})


def results_rules(df: DataFrame) -> DataFrame:
    df = _rewrite(
        df,
        {
            "fastestlapspeed": "try_cast(fastestlapspeed AS DOUBLE)",
            "fastestlap": "try_cast(fastestlap AS INT)",
            "fastestlaptime": time_to_ms_sql("fastestlaptime"),
        },
    )
    return df.drop("time")


def pit_stops_rules(df: DataFrame) -> DataFrame:
    return _rewrite(df, {"duration": time_to_ms_sql("duration"), "time": clean_wall_clock_sql("`time`")})


def lap_times_rules(df: DataFrame) -> DataFrame:
    return df.drop("time")


def qualifying_rules(df: DataFrame) -> DataFrame:
    return _rewrite(df, {c: time_to_ms_sql(ident(c)) for c in ("q1", "q2", "q3") if c in df.columns})


def sprint_results_rules(df: DataFrame) -> DataFrame:
    df = _rewrite(
        df,
        {
            "fastestlaptime": time_to_ms_sql("fastestlaptime"),
            "fastestlap": "try_cast(fastestlap AS INT)",
            "rank": "try_cast(`rank` AS INT)",
        },
    )
    return df.drop("time")


def seasons_rules(df: DataFrame) -> DataFrame:
    return _rewrite(df, {"year": season_start_sql("`year`")})


def safety_cars_rules(df: DataFrame) -> DataFrame:
    return _rewrite(df, {"cause": normalise_cause_sql("cause")})


TABLE_RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "race_data_races": races_rules,
    "race_data_results": results_rules,
    "race_data_pit_stops": pit_stops_rules,
    "race_data_lap_times": lap_times_rules,
    "race_data_qualifying": qualifying_rules,
    "race_data_sprint_results": sprint_results_rules,
    "race_data_seasons": seasons_rules,
    "race_events_safety_cars": safety_cars_rules,
}


def apply_table_rules(df: DataFrame, table_name: str) -> DataFrame:
    rule = TABLE_RULES.get(table_name)
    return df if rule is None else rule(df)


def to_silver(df: DataFrame, table_name: str, century_pivot: str = DEFAULT_CENTURY_PIVOT) -> DataFrame:
    """The full Bronze -> Silver chain for one table (no run stamp)."""
    return apply_table_rules(apply_general_rules(df, table_name, century_pivot), table_name)
