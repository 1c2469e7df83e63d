"""Duration, wall-clock and date parsing as native expressions.

No UDFs: each rule is Spark SQL expression text (``*_sql``, composable)
with a Column wrapper taking a column name; all of it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import col_sql, lit_sql

# The date layouts tried in order for columns whose name
# contains "date" or "dob". The first is ISO; the other four read a
# two-digit year and go through the century pivot below.
ISO_DATE_FORMAT = "yyyy-MM-dd"
SHORT_YEAR_DATE_FORMATS = ("MM/dd/yy", "M/d/yy", "M/dd/yy", "MM/d/yy")

# Default latest date a two-digit year may denote; later results move back
# 100 years ("71" -> 1971, "20" -> 2020).
DEFAULT_CENTURY_PIVOT = "2029-12-31"

# A duration is [[h:]m:]s[.f...]: up to three colon groups, any number of
# fraction digits (cut to milliseconds).
DURATION_PATTERN = r"^(\d+:){0,2}\d+(\.\d+)?$"

# Fixed value: the wall clock kept from a time-of-day string.
WALL_CLOCK_PATTERN = r"(\d{1,2}:\d{2}:\d{2}).*"


def time_to_ms_sql(x: str) -> str:
    parts = f"split({x}, ':')"
    n = f"size({parts})"
    last = f"get({parts}, {n} - 1)"
    # '\\.' (an escaped dot) takes Java's split fast path; '[.]' would
    # compile a regex per row
    whole = f"try_cast(get(split({last}, '\\\\.'), 0) AS BIGINT)"
    frac = f"coalesce(try_cast(rpad(left(get(split({last}, '\\\\.'), 1), 3), 3, '0') AS BIGINT), 0)"
    mins = f"coalesce(try_cast(get({parts}, {n} - 2) AS BIGINT), 0)"
    hours = f"coalesce(try_cast(get({parts}, {n} - 3) AS BIGINT), 0)"
    total = f"{hours} * 3600000 + {mins} * 60000 + {whole} * 1000 + {frac}"
    return f"(CASE WHEN {x} RLIKE {lit_sql(DURATION_PATTERN)} THEN try_cast({total} AS INT) END)"


def time_to_ms(c: str) -> Column:
    """``[[h:]m:]s[.fff]`` text to integer milliseconds.

    ``1:26.5`` -> 86500, ``23.456`` -> 23456, ``83`` -> 83000,
    ``1:02:03.456`` -> 3723456. NULL or malformed text gives NULL.
    """
    return F.expr(time_to_ms_sql(col_sql(c)))


def clean_wall_clock_sql(x: str) -> str:
    return f"regexp_replace({x}, {lit_sql(WALL_CLOCK_PATTERN)}, '$1')"


def clean_wall_clock(c: str) -> Column:
    """Keep the first ``H:MM:SS`` and cut what follows (``14:00:00Z`` ->
    ``14:00:00``); text without a clock passes through unchanged."""
    return F.expr(clean_wall_clock_sql(col_sql(c)))


def parse_multi_format_date_sql(x: str, century_pivot: str = DEFAULT_CENTURY_PIVOT) -> str:
    # A layout is only tried on text containing its separator: same result,
    # but no parse (and no parse exception) for text that cannot match.
    iso = f"(CASE WHEN instr({x}, '-') > 0 THEN try_to_date({x}, {lit_sql(ISO_DATE_FORMAT)}) END)"
    short = (
        f"(CASE WHEN instr({x}, '/') > 0 THEN coalesce("
        + ", ".join(f"try_to_date({x}, {lit_sql(f)})" for f in SHORT_YEAR_DATE_FORMATS)
        + ") END)"
    )
    pivot = f"DATE {lit_sql(century_pivot)}"
    return f"coalesce({iso}, (CASE WHEN {short} > {pivot} THEN add_months({short}, -1200) ELSE {short} END))"


def parse_multi_format_date(c: str, century_pivot: str = DEFAULT_CENTURY_PIVOT) -> Column:
    """First layout that parses wins: ISO, then the two-digit-year layouts.

    Two-digit years read as 20yy and move back a century when past
    ``century_pivot``; the pivot is explicit so results do not depend on
    the day the job runs.
    """
    return F.expr(parse_multi_format_date_sql(col_sql(c), century_pivot))


def season_start_sql(x: str) -> str:
    return f"make_date({x}, 1, 1)"


def year_to_season_start(c: str) -> Column:
    """Integer season year to the first day of that year."""
    return F.expr(season_start_sql(col_sql(c)))


def session_timestamp(date_col: str, time_col: str) -> Column:
    """Date plus wall-clock text to a (time-zone free) timestamp; NULL when
    either is NULL or the pair does not parse."""
    d, t = col_sql(date_col), col_sql(time_col)
    return F.expr(
        f"CAST(try_to_timestamp(concat(CAST({d} AS STRING), ' ', {t}), 'yyyy-MM-dd H:mm:ss') AS TIMESTAMP_NTZ)"
    )
