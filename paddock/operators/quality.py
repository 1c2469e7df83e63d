"""Data-quality suites as Spark aggregations.

A suite is a list of ``Check`` specs per table. ``check_table`` turns
all value checks of one table into ONE aggregation (``count_if`` per
check, partial aggregates per task, a single-row result) and unpivots it
with ``stack`` into one report row per check; schema checks (type,
absent column) are decided from the DataFrame schema and emitted in the
same ``stack``. No data is pulled to the driver.

Report columns: table_name, check_name, column_name, unexpected_count
(NULL for schema checks, and for a column that is missing), success, rule
(the predicate checked), first_example (the smallest offending value, as
text).

``failure_examples`` adds up to five examples per failed check (a
distributed top-k per check, only for checks that failed) and
``gate`` raises when any check failed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from ..functions._col import ident, lit_sql


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | of_type | in_set | not_match | match | between | absent | unique
    column: str
    arg: object = None


CHECK_NAMES = {
    "not_null": "expect_not_null",
    "of_type": "expect_of_type",
    "in_set": "expect_in_set",
    "not_match": "expect_not_match_regex",
    "match": "expect_match_regex",
    "between": "expect_between",
    "absent": "expect_column_absent",
    "unique": "expect_unique",
}

# Patterns used by the suites.
CODE_LEFTOVER = r"^[RDENFW\-\\]$"
TRIMMED = r"^\S.*\S$|^\S$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
SEASON_START = r"^\d{4}-01-01$"
CAUSE_LEFTOVER = r"(?i)accident[s/]|stranded car/"

# Allowed circuit countries (only the mapped "South Korea").
COUNTRIES = (
    "Australia", "Malaysia", "Bahrain", "Spain", "Monaco", "Turkey", "Canada", "United States",
    "France", "Germany", "Hungary", "Belgium", "Italy", "Singapore", "Japan", "China", "Brazil",
    "United Arab Emirates", "United Kingdom", "Argentina", "Mexico", "Portugal", "Morocco",
    "Netherlands", "Austria", "Sweden", "Switzerland", "South Africa", "South Korea", "India",
    "Russia", "Azerbaijan", "Saudi Arabia", "Qatar", "Vietnam",
)
RESTARTS = ("Resumed", "Standing Start", "Rolling Start", "Not Resumed")

INT, DOUBLE = IntegerType(), DoubleType()


def _nn(*cols):
    return [Check("not_null", c) for c in cols]


def _typed(t, *cols):
    return [Check("of_type", c, t) for c in cols]


# The suites per Silver table.
SUITES: dict[str, list[Check]] = {
    "race_data_circuits": _nn("circuitid", "country") + [Check("in_set", "country", COUNTRIES)],
    "race_data_constructor_results": _nn("raceid", "constructorid") + [Check("in_set", "status", ("Disqualified",))],
    "race_data_constructor_standings": _nn("raceid", "constructorid")
    + _typed(INT, "position")
    + [Check("not_match", "positiontext", CODE_LEFTOVER)],
    "race_data_constructors": _nn("constructorid", "name"),
    "race_data_driver_standings": _nn("raceid", "driverid")
    + _typed(INT, "position")
    + [Check("not_match", "positiontext", CODE_LEFTOVER)],
    "race_data_drivers": _nn("driverid", "forename", "surname")
    + [Check("match", "forename", TRIMMED), Check("match", "surname", TRIMMED)]
    + _typed(INT, "number")
    + [Check("match", "dob", ISO_DATE)],
    "race_data_lap_times": _nn("raceid", "driverid", "lap")
    + [Check("between", "lap", (1, 100))]
    + _typed(INT, "milliseconds")
    + _nn("milliseconds"),
    "race_data_pit_stops": _nn("raceid", "driverid", "stop", "lap") + _typed(INT, "milliseconds"),
    "race_data_qualifying": _nn("raceid", "driverid", "constructorid") + _typed(INT, "q1", "q2", "q3"),
    "race_data_races": _nn("raceid", "date", "circuitid")
    + [Check("match", c, ISO_DATE) for c in ("date", "fp1_date", "fp2_date", "fp3_date", "quali_date", "sprint_date")],
    "race_data_results": _nn("resultid", "raceid", "driverid", "constructorid")
    + [Check("between", "positionorder", (1, 40))]
    + _typed(INT, "number", "grid", "position", "rank", "milliseconds")
    + [Check("not_match", "positiontext", CODE_LEFTOVER)]
    + _typed(DOUBLE, "fastestlapspeed"),
    "race_data_seasons": _nn("year") + [Check("match", "year", SEASON_START)],
    "race_data_sprint_results": _nn("raceid", "driverid", "constructorid")
    + _typed(INT, "position", "milliseconds", "rank")
    + [Check("not_match", "positiontext", CODE_LEFTOVER)],
    "race_data_status": _nn("statusid", "status"),
    "race_events_fatal_accidents_drivers": _nn("driver") + [Check("match", "date_of_accident", ISO_DATE)],
    "race_events_fatal_accidents_marshalls": _nn("name") + [Check("match", "date_of_accident", ISO_DATE)],
    "race_events_red_flags": _nn("race") + [Check("in_set", "resumed", RESTARTS)],
    "race_events_safety_cars": _nn("race", "cause", "deployed") + [Check("not_match", "cause", CAUSE_LEFTOVER)],
}

# Gold suites: keys the star schema joins on must be unique (a second
# race of the same name in a season would make ``race_key`` fan out).
GOLD_SUITES: dict[str, list[Check]] = {
    "dim_races": [Check("unique", "race_id"), Check("unique", "race_key")],
    "dim_drivers": [Check("unique", "driver_id")],
    "dim_teams": [Check("unique", "team_id")],
    "dim_circuits": [Check("unique", "circuit_id")],
    "standings_drivers": [Check("unique", "race_id,driver_id")],
    "standings_teams": [Check("unique", "race_id,team_id")],
}

# Checks every table gets, and the races-only one.
GLOBAL_CHECKS = [Check("absent", "url")]
TABLE_GLOBAL_CHECKS = {"race_data_races": [Check("absent", "year")]}


def suite_for(table: str) -> list[Check]:
    """The table's suite plus the global checks (unknown table: globals only)."""
    return list(SUITES.get(table, [])) + GLOBAL_CHECKS + TABLE_GLOBAL_CHECKS.get(table, [])


def failure_sql(check: Check) -> str | None:
    """SQL predicate that is true on an offending row (value checks only).

    As in column-map expectations, NULLs only fail the not-null check.
    """
    c = ident(check.column)
    txt = f"CAST({c} AS STRING)"
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "in_set":
        vals = ", ".join(lit_sql(v) for v in check.arg)
        return f"{c} IS NOT NULL AND NOT ({c} IN ({vals}))"
    if check.kind == "not_match":
        return f"{c} IS NOT NULL AND {txt} RLIKE {lit_sql(check.arg)}"
    if check.kind == "match":
        return f"{c} IS NOT NULL AND NOT ({txt} RLIKE {lit_sql(check.arg)})"
    if check.kind == "between":
        lo, hi = check.arg
        return f"{c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})"
    return None


def failing(df: DataFrame, checks: list[Check]) -> Column:
    """The rules of the value checks that a row fails, in order; a check on a
    column that ``df`` lacks fails every row."""
    rules = []
    for chk in checks:
        fail = failure_sql(chk) if chk.column in df.columns else "true"
        if fail is not None:
            rules.append(F.when(F.expr(fail), F.lit(rule_text(chk))))
    return F.array_compact(F.array(*rules)) if rules else F.expr("CAST(array() AS array<string>)")


def rule_text(check: Check) -> str:
    """The rule that the column must satisfy, as a predicate, with all of
    its allowed values or its whole pattern."""
    c = check.column
    if check.kind == "of_type":
        return f"{c}: {check.arg.simpleString()}"
    if check.kind == "in_set":
        return f"{c} IN ({', '.join(lit_sql(v) for v in check.arg)})"
    if check.kind == "match":
        return f"{c} RLIKE {check.arg}"
    if check.kind == "not_match":
        return f"{c} NOT RLIKE {check.arg}"
    if check.kind == "between":
        return f"{c} BETWEEN {check.arg[0]} AND {check.arg[1]}"
    if check.kind == "absent":
        return f"no {c}"
    if check.kind == "unique":
        return f"unique {c}"
    return f"{c} IS NOT NULL"


def check_table(df: DataFrame, table: str, checks: list[Check] | None = None) -> DataFrame:
    """One aggregation over ``df``; one report row per check."""
    checks = suite_for(table) if checks is None else checks
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[str] = []
    rows: list[str] = []
    unique: list[tuple[list[str], str]] = []
    for i, chk in enumerate(checks):
        name = CHECK_NAMES[chk.kind]
        meta = f"{lit_sql(table)}, {lit_sql(name)}, {lit_sql(chk.column)}"
        rule = lit_sql(rule_text(chk))
        undecided = f"{meta}, CAST(NULL AS BIGINT), %s, {rule}, CAST(NULL AS STRING)"
        if chk.kind == "absent":
            rows.append(undecided % str(chk.column not in fields).lower())
        elif not all(c in fields for c in (chk.column.split(",") if chk.kind == "unique" else [chk.column])):
            rows.append(undecided % "false")
        elif chk.kind == "of_type":
            rows.append(undecided % str(fields[chk.column] == chk.arg).lower())
        elif chk.kind == "unique":
            keys = [ident(c) for c in chk.column.split(",")]
            unique.append((keys, f"{meta}, n, n = 0, {rule}, CAST(NULL AS STRING)"))
        else:
            fail = failure_sql(chk)
            aggs.append(f"count_if({fail}) AS n{i}")
            aggs.append(f"min(CASE WHEN {fail} THEN CAST({ident(chk.column)} AS STRING) END) AS x{i}")
            rows.append(f"{meta}, n{i}, n{i} = 0, {rule}, x{i}")
    base = df.selectExpr(*aggs) if aggs else df.sparkSession.range(1).selectExpr("1 AS one")
    names = "AS (table_name, check_name, column_name, unexpected_count, success, rule, first_example)"
    parts = [base.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) {names}")] if rows else []
    for keys, row in unique:
        # rows beyond the first of each key: one grouped count per key, not a
        # distinct count that multiplies the rows by the number of keys
        beyond = df.groupBy(*(F.expr(k) for k in keys)).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
        parts.append(beyond.selectExpr(f"stack(1, {row}) {names}"))
    return reduce(DataFrame.unionByName, parts)


#: what a check's state holds for each part of a table
STATE = "table_name string, check_name string, column_name string, rule string, part string, rows bigint, unexpected_count bigint, success boolean, first_example string"


def check_states(df: DataFrame, table: str, part: Column, checks: list[Check] | None = None) -> DataFrame:
    """The suite by part (a season, a day): one grouped aggregation, a row
    (``STATE``) for each part and check. States of parts add up to the report of
    the whole table (``merge_states``), so a new part is checked alone. Unique
    keys don't add up and have no state: check those on the whole table."""
    checks = suite_for(table) if checks is None else checks
    if lone := [c.column for c in checks if c.kind == "unique"]:
        raise ValueError(f"uniqueness of {lone} doesn't follow from its parts")
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = ["count(1) AS n_rows"], []
    for i, chk in enumerate(checks):
        meta = f"{lit_sql(table)}, {lit_sql(CHECK_NAMES[chk.kind])}, {lit_sql(chk.column)}, {lit_sql(rule_text(chk))}, part, n_rows"
        plain = {"absent": chk.column not in fields, "of_type": fields.get(chk.column) == chk.arg}.get(chk.kind, False)
        if chk.kind in ("absent", "of_type") or chk.column not in fields:
            rows.append(f"{meta}, CAST(NULL AS BIGINT), {str(plain).lower()}, CAST(NULL AS STRING)")
            continue
        fail = failure_sql(chk)
        aggs += [f"count_if({fail}) AS n{i}", f"min(CASE WHEN {fail} THEN CAST({ident(chk.column)} AS STRING) END) AS x{i}"]
        rows.append(f"{meta}, n{i}, n{i} = 0, x{i}")
    each = df.withColumn("part", part.cast("string")).groupBy("part").agg(*(F.expr(a) for a in aggs))
    names = ", ".join(c.split()[0] for c in STATE.split(", "))
    return each.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def merge_states(states: DataFrame) -> DataFrame:
    """The report (as of ``check_table``) of the parts together."""
    return states.groupBy("table_name", "check_name", "column_name", "rule").agg(
        F.sum("unexpected_count").alias("unexpected_count"), F.bool_and("success").alias("success"), F.min("first_example").alias("first_example")
    )


def check_tables(sources, tables) -> DataFrame:
    """Run the suites of several tables; one report (union of per-table passes)."""
    return reduce(DataFrame.unionByName, [check_table(sources(t), t) for t in tables])


def table_verdicts(report: DataFrame) -> DataFrame:
    """Passed / failed per table, with the number of failed checks."""
    return report.groupBy("table_name").agg(
        F.bool_and("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed_checks"),
        F.count(F.lit(1)).alias("checks"),
    )


def failure_examples(df: DataFrame, table: str, failed_columns: list[tuple[str, str]], k: int = 5) -> DataFrame:
    """The ``k`` smallest offending values (of rows, so a value may recur) per
    failed value check.

    ``failed_columns`` lists (check_name, column) pairs that failed (read
    from a collected report, which has one row per check). Each list is a
    distributed top-k: a check that fails on every row moves at most k
    values per task.
    """
    by_key = {(CHECK_NAMES[c.kind], c.column): c for c in suite_for(table)}
    parts = []
    for key in failed_columns:
        chk = by_key.get(key)
        if chk is None or failure_sql(chk) is None or chk.kind == "not_null":
            continue
        v = F.expr(f"CAST({ident(chk.column)} AS STRING)")
        parts.append(
            df.where(failure_sql(chk))
            .select(v.alias("value"))
            .orderBy("value")
            .limit(k)
            .select(F.lit(table).alias("table_name"), F.lit(key[0]).alias("check_name"), F.lit(key[1]).alias("column_name"), "value")
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "table_name string, check_name string, column_name string, examples string")
    ex = reduce(DataFrame.unionByName, parts)
    return ex.groupBy("table_name", "check_name", "column_name").agg(
        F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("examples")
    )


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> None:
    """Raise if any check failed (collects only the failed report rows,
    at most one per check)."""
    failed = report.where(~F.col("success")).select("table_name", "check_name", "column_name").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name}: {r.check_name}" for r in failed]
        raise QualityGateError(f"{len(failed)} quality checks failed: " + "; ".join(lines))
