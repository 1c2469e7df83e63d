"""Text rules: whole-value maps, cause normalisation, classified flag.

Each rule has a ``*_sql`` form that takes SQL expression text (so rules
can nest) and a Column form that takes a column name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import col_sql, lit_sql

# The whole-value map for race_data tables (after trim,
# case-sensitive). A None target turns the sentinel into NULL.
RACE_DATA_VALUE_MAP: dict[str, str | None] = {
    "R": "Retired",
    "D": "Disqualified",
    "E": "Excluded",
    "F": "Failed",
    "N": "Not Classified",
    "W": "Withdrawn",
    "\\N": None,
    "-": None,
    "USA": "United States",
    "UK": "United Kingdom",
    "UAE": "United Arab Emirates",
    "Korea": "South Korea",
}

# The restart map for race_events tables. The NULL
# sentinels are applied to these tables as well.
RACE_EVENTS_VALUE_MAP: dict[str, str | None] = {
    "R": "Resumed",
    "S": "Standing Start",
    "Y": "Rolling Start",
    "N": "Not Resumed",
    "\\N": None,
    "-": None,
}

# Safety-car cause patterns, tried in order, first match wins.
CAUSE_PATTERNS: tuple[tuple[str, str], ...] = (
    ("(?i).*accident.*", "Accident(s)"),
    ("(?i).*stranded car.*", "Stranded Car(s)"),
    ("(?i).*debris.*", "Debris"),
)

# Fixed value: a classified finishing position is all digits.
CLASSIFIED_PATTERN = "^[0-9]+$"


def map_values_sql(x: str, mapping: Mapping[str, str | None]) -> str:
    """Whole-value replacement as one flat CASE; unmapped values pass."""
    if not mapping:
        return x
    whens = " ".join(f"WHEN {x} = {lit_sql(k)} THEN {lit_sql(v)}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {x} END)"


def map_values(c: str, mapping: Mapping[str, str | None]) -> Column:
    return F.expr(map_values_sql(col_sql(c), mapping))


def normalise_cause_sql(x: str, patterns=CAUSE_PATTERNS) -> str:
    whens = " ".join(f"WHEN {x} RLIKE {lit_sql(p)} THEN {lit_sql(label)}" for p, label in patterns)
    return f"(CASE {whens} ELSE {x} END)"


def normalise_cause(c: str, patterns=CAUSE_PATTERNS) -> Column:
    """Ordered case-insensitive regex rewrite; no match keeps the value."""
    return F.expr(normalise_cause_sql(col_sql(c), patterns))


def not_classified_flag_sql(x: str) -> str:
    return f"(CASE WHEN NOT ({x} RLIKE {lit_sql(CLASSIFIED_PATTERN)}) THEN true ELSE false END)"


def not_classified_flag(c: str) -> Column:
    """True when the position text is not all digits; NULL text is False."""
    return F.expr(not_classified_flag_sql(col_sql(c)))
