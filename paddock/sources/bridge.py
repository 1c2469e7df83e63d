"""Bronze tables in the race-data schema, derived by Spark from the
provided TPC-H-style tables.

The provided test data has no race tables, so each Bronze table is a
projection of a provided table (results, laps, stops, standings from
``lineitem``; races and accidents from ``orders``; circuits from
``customer``; drivers from ``supplier``; teams from ``part``; status
from ``nation``; incidents from ``events``). Every derived table grows
with its source, and dirt (blank padding, code letters, ``\\N`` and
``-`` sentinels, short-year dates, clock suffixes, mixed duration
layouts) is a deterministic function of the source row, so DuckDB can
derive the same rows for the oracle.

Narrow projections, plus a DISTINCT for seasons and a keyed aggregate for
the two standings snapshots (one row per race and driver/team, with
map-side partial aggregation); no joins, and Parquet pushdown keeps each
scan to the columns used. Each projection is SQL expression text, one
JVM call per table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcasts, join_width, spread

SENT = r"'\\N'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a provided table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _duration_text(price: str, style: str) -> str:
    """Lap-time-like text from a price: ``m:ss.fff`` (style 0), ``ss.fff``
    (1), ``m:ss.f`` (2) or whole seconds (otherwise)."""
    cents = f"CAST(floor(({price}) * 100) AS BIGINT)"
    secs = f"({cents} % 60)"
    frac = f"({cents} % 1000)"
    mins = f"(CAST(floor({cents} / 60) AS BIGINT) % 3 + 1)"
    s = lambda e: f"CAST({e} AS STRING)"
    return (
        f"CASE WHEN ({style}) = 0 THEN concat({s(mins)}, ':', lpad({s(secs)}, 2, '0'), '.', lpad({s(frac)}, 3, '0')) "
        f"WHEN ({style}) = 1 THEN concat({s(secs + ' + 20')}, '.', lpad({s(frac)}, 3, '0')) "
        f"WHEN ({style}) = 2 THEN concat({s(mins)}, ':', lpad({s(secs)}, 2, '0'), '.', {s(frac + ' % 10')}) "
        f"ELSE {s(secs + ' + 60')} END"
    )


def _iso(days: int) -> str:
    return f"date_format(date_sub(to_date(o_orderdate), {days}), 'yyyy-MM-dd')"


_POSITION_TEXT = (
    "CASE WHEN l_returnflag = 'R' THEN 'R' WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS STRING) "
    "WHEN l_linestatus = 'O' THEN 'D' ELSE 'W' END"
)

_ACCIDENT_DATE = (
    "CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
    "WHEN 1 THEN date_format(o_orderdate, 'MM/dd/yy') WHEN 2 THEN date_format(o_orderdate, 'M/d/yy') "
    "WHEN 3 THEN date_format(o_orderdate, 'M/dd/yy') ELSE date_format(o_orderdate, 'MM/d/yy') END"
)

_BORN = "make_date(1960 + s_nationkey, 1 + s_nationkey % 12, 1 + s_nationkey)"

# table -> (source table, optional filter, projection)
BRONZE_SQL: dict[str, tuple[str, str | None, list[str]]] = {
    "race_data_circuits": (
        "customer",
        None,
        [
            "c_custkey AS circuitid",
            "lower(c_name) AS circuitref",
            "concat('  ', c_name, ' ') AS name",
            "c_mktsegment AS location",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'UK' WHEN 'BUILDING' THEN 'USA' "
            "WHEN 'FURNITURE' THEN ' UAE ' WHEN 'HOUSEHOLD' THEN 'Korea' ELSE 'Monaco' END AS country",
            "c_acctbal / 100.0 AS lat",
            "CAST(c_nationkey AS DOUBLE) * 2.5 AS lng",
            "c_nationkey * 10 AS alt",
            "concat('https://example.org/circuit/', CAST(c_custkey AS STRING)) AS url",
        ],
    ),
    "race_data_races": (
        "orders",
        None,
        [
            "o_orderkey AS raceid",
            "year(o_orderdate) AS year",
            "month(o_orderdate) AS round",
            "o_custkey AS circuitid",
            "concat(o_orderpriority, ' Race ', CAST(o_orderkey AS STRING)) AS name",
            f"{_iso(0)} AS date",
            f"CASE o_orderstatus WHEN 'F' THEN '14:00:00Z' WHEN 'O' THEN '9:30:00.000' ELSE {SENT} END AS time",
            f"{_iso(2)} AS fp1_date",
            "'11:30:00' AS fp1_time",
            f"{_iso(2)} AS fp2_date",
            "' 15:00:00 ' AS fp2_time",
            f"CASE WHEN o_orderpriority = '1-URGENT' THEN {SENT} ELSE {_iso(1)} END AS fp3_date",
            f"CASE WHEN o_orderpriority = '1-URGENT' THEN {SENT} ELSE '11:30:00+01' END AS fp3_time",
            f"{_iso(1)} AS quali_date",
            "'15:00:00' AS quali_time",
            f"CASE WHEN o_orderpriority = '1-URGENT' THEN {_iso(1)} ELSE {SENT} END AS sprint_date",
            f"CASE WHEN o_orderpriority = '1-URGENT' THEN '10:30:00' ELSE {SENT} END AS sprint_time",
            "concat('https://example.org/race/', CAST(o_orderkey AS STRING)) AS url",
        ],
    ),
    "race_data_drivers": (
        "supplier",
        None,
        [
            "s_suppkey AS driverid",
            "lower(s_name) AS driverref",
            f"CASE WHEN s_nationkey < 5 THEN {SENT} ELSE CAST(s_nationkey AS STRING) END AS number",
            "concat('S', CAST(s_nationkey AS STRING)) AS code",
            "concat(' ', substr(s_name, 1, 8)) AS forename",
            "concat(substr(s_name, 10), ' ') AS surname",
            f"CASE WHEN s_nationkey < 10 THEN date_format({_BORN}, 'yyyy-MM-dd') "
            f"WHEN s_nationkey < 15 THEN date_format({_BORN}, 'M/d/yy') "
            f"WHEN s_nationkey < 20 THEN date_format({_BORN}, 'MM/dd/yy') ELSE 'unknown' END AS dob",
            "CASE WHEN s_nationkey < 8 THEN 'UK' ELSE concat('Nation ', CAST(s_nationkey AS STRING)) END AS nationality",
            "concat('https://example.org/driver/', CAST(s_suppkey AS STRING)) AS url",
        ],
    ),
    "race_data_constructors": (
        "part",
        None,
        [
            "p_partkey AS constructorid",
            "lower(p_brand) AS constructorref",
            "concat(' ', p_name, ' ') AS name",
            "p_type AS nationality",
            "concat('https://example.org/team/', CAST(p_partkey AS STRING)) AS url",
        ],
    ),
    "race_data_status": ("nation", None, ["n_nationkey AS statusid", "n_name AS status"]),
    "race_data_results": (
        "lineitem",
        None,
        [
            "l_orderkey * 10 + l_linenumber AS resultid",
            "l_orderkey AS raceid",
            "l_suppkey AS driverid",
            "l_partkey AS constructorid",
            "CAST(l_linenumber AS STRING) AS number",
            f"CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN {SENT} ELSE CAST(l_linenumber - 1 AS STRING) END AS grid",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS STRING) END AS position",
            f"{_POSITION_TEXT} AS positiontext",
            "l_linenumber AS positionorder",
            "l_quantity AS points",
            "CAST(floor(l_quantity) AS INT) AS laps",
            "concat('+', CAST(l_linenumber AS STRING), '.000') AS time",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING) END AS milliseconds",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber + 40 AS STRING) END AS fastestlap",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS STRING) END AS rank",
            _duration_text("l_extendedprice", "CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE 2 END")
            + " AS fastestlaptime",
            "CAST(CAST(200 + l_discount * 100 AS DECIMAL(8,3)) AS STRING) AS fastestlapspeed",
            "l_linenumber AS statusid",
        ],
    ),
    "race_data_sprint_results": (
        "lineitem",
        None,
        [
            "l_orderkey AS raceid",
            "l_suppkey AS driverid",
            "l_partkey AS constructorid",
            "CAST(l_linenumber AS STRING) AS number",
            "CAST(l_linenumber AS STRING) AS grid",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS STRING) END AS position",
            f"{_POSITION_TEXT} AS positiontext",
            "l_linenumber AS positionorder",
            "round(l_tax * 100) AS points",
            "CAST(floor(l_quantity / 2) AS INT) AS laps",
            "'+1.5' AS time",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(CAST(floor(l_extendedprice * 10) AS BIGINT) AS STRING) END AS milliseconds",
            f"CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber + 10 AS STRING) END AS fastestlap",
            "CASE WHEN l_returnflag = 'R' THEN '-' ELSE CAST(l_linenumber AS STRING) END AS rank",
            _duration_text("l_extendedprice + l_tax", "CASE WHEN l_linestatus = 'F' THEN 0 ELSE 3 END") + " AS fastestlaptime",
            "l_linenumber AS statusid",
        ],
    ),
    "race_data_qualifying": (
        "lineitem",
        None,
        [
            "l_orderkey AS raceid",
            "l_suppkey AS driverid",
            "l_partkey AS constructorid",
            "CAST(l_linenumber AS STRING) AS number",
            "CAST(l_linenumber AS STRING) AS position",
            _duration_text("l_extendedprice", "0") + " AS q1",
            _duration_text("l_extendedprice + 1", "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END") + " AS q2",
            f"CASE WHEN l_returnflag = 'A' THEN {_duration_text('l_extendedprice + 2', '0')} ELSE {SENT} END AS q3",
        ],
    ),
    "race_data_lap_times": (
        "lineitem",
        None,
        [
            "l_orderkey AS raceid",
            "l_suppkey AS driverid",
            "l_linenumber AS lap",
            "CAST(l_linenumber AS STRING) AS position",
            _duration_text("l_extendedprice", "0") + " AS time",
            "CAST(CAST(floor(l_extendedprice * 3) AS BIGINT) AS STRING) AS milliseconds",
        ],
    ),
    "race_data_pit_stops": (
        "lineitem",
        None,
        [
            "l_orderkey AS raceid",
            "l_suppkey AS driverid",
            "l_linenumber AS stop",
            "CAST(floor(l_quantity) AS INT) AS lap",
            "concat(CAST(12 + l_linenumber AS STRING), ':', lpad(CAST(l_linenumber * 7 AS STRING), 2, '0'), ':', "
            "lpad(CAST(CAST(floor(l_quantity) AS INT) AS STRING), 2, '0'), "
            "CASE WHEN l_linestatus = 'O' THEN '.123' ELSE '' END) AS time",
            _duration_text(
                "l_discount * 1000 + l_tax * 100",
                "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 0 ELSE 3 END",
            )
            + " AS duration",
            "CAST(CAST(floor(l_discount * 100000) AS BIGINT) AS STRING) AS milliseconds",
        ],
    ),
    "race_data_constructor_results": (
        "lineitem",
        None,
        [
            "l_orderkey AS raceid",
            "l_partkey AS constructorid",
            f"CASE WHEN l_returnflag = 'R' THEN 'D' ELSE {SENT} END AS status",
        ],
    ),
    "race_events_safety_cars": (
        "events",
        "event_type IN ('error', 'click', 'view')",
        [
            "concat('Race ', CAST(user_id AS STRING)) AS race",
            "CASE WHEN event_type = 'error' THEN 'Accident/Debris' "
            "WHEN event_type = 'click' AND value > 10 THEN 'Multiple accidents' "
            "WHEN event_type = 'click' THEN 'Stranded car/Rain' "
            "WHEN value > 10 THEN 'debris on track' ELSE ' Rain ' END AS cause",
            "CAST(floor(value) AS INT) AS deployed",
            "value + 3.0 AS retreated",
            "CAST(floor(value / 2) AS INT) AS fulllaps",
        ],
    ),
    "race_events_red_flags": (
        "events",
        "event_type IN ('purchase', 'signup')",
        [
            "concat('Race ', CAST(user_id AS STRING)) AS race",
            "CAST(floor(value) AS INT) AS lap",
            "concat('Incident ', CAST(event_id AS STRING)) AS incident",
            f"CASE WHEN value < 5 THEN 'R' WHEN value < 10 THEN 'S' WHEN value < 15 THEN 'Y' "
            f"WHEN value < 20 THEN 'N' ELSE {SENT} END AS resumed",
            "CASE WHEN event_type = 'signup' THEN concat('Driver ', CAST(user_id AS STRING)) ELSE '-' END AS excluded",
        ],
    ),
    "race_events_fatal_accidents_drivers": (
        "orders",
        "o_orderstatus = 'F'",
        [
            "concat(' Driver ', CAST(o_custkey AS STRING)) AS driver",
            "month(o_orderdate) + 20 AS age",
            f"{_ACCIDENT_DATE} AS date_of_accident",
            "concat(CAST(year(o_orderdate) AS STRING), ' ', o_orderpriority, ' Race') AS event",
            "concat('Car ', CAST(o_custkey AS STRING)) AS car",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Practice' ELSE 'Race' END AS session",
        ],
    ),
    "race_events_fatal_accidents_marshalls": (
        "orders",
        "NOT o_orderstatus <=> 'F'",
        [
            "concat('Marshal ', CAST(o_orderkey AS STRING)) AS name",
            "dayofmonth(o_orderdate) + 18 AS age",
            f"{_ACCIDENT_DATE} AS date_of_accident",
            "concat(CAST(year(o_orderdate) AS STRING), ' ', o_orderpriority, ' Race') AS event",
        ],
    ),
}


# Standings are snapshots: one row per race and driver (team), so they are
# derived with a keyed aggregate (order-independent min/max, exact in any
# engine) and the dashboard's left joins on them are N:1.
STANDINGS_SQL: dict[str, tuple[list[str], list[str]]] = {
    "race_data_driver_standings": (
        ["l_orderkey AS raceid", "l_suppkey AS driverid"],
        [
            "CAST(floor(max(l_extendedprice) / 10) AS DOUBLE) / 100 AS points",
            f"CASE WHEN count_if(l_returnflag = 'R') > 0 THEN {SENT} ELSE CAST(min(l_linenumber) AS STRING) END AS position",
            "CASE WHEN count_if(l_returnflag = 'R') > 0 THEN '-' ELSE CAST(min(l_linenumber) AS STRING) END AS positiontext",
            "max(CAST(round(l_discount * 100) AS INT)) AS wins",
        ],
    ),
    "race_data_constructor_standings": (
        ["l_orderkey AS raceid", "l_partkey AS constructorid"],
        [
            "max(l_quantity) AS points",
            "CAST(min(l_linenumber) AS STRING) AS position",
            "CASE WHEN count_if(l_linestatus = 'F') > 0 THEN 'E' ELSE CAST(min(l_linenumber) AS STRING) END AS positiontext",
            "max(CAST(round(l_tax * 100) AS INT)) AS wins",
        ],
    ),
}


def _standings(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    keys, aggs = STANDINGS_SQL[name]
    li = read_table(spark, sf_dir, "lineitem")
    key_names = [k.rsplit(" AS ", 1)[1] for k in keys]
    rows = li.selectExpr(*keys, "*")
    if width := join_width(li):  # hardly two rows share a key: one table of groups a task, of bounded size
        # by race, or by what the groups are shuffled for next
        by_team = name == "race_data_constructor_standings" and not broadcasts(read_table(spark, sf_dir, "part"))
        rows = spread(rows, width, key_names[by_team])
    return rows.groupBy(*key_names).agg(*[F.expr(a) for a in aggs])


def _seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row per season; the partial aggregate per task keeps the shuffle tiny
    return read_table(spark, sf_dir, "orders").selectExpr("year(o_orderdate) AS year").distinct()


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "race_data_seasons":
        return _seasons(spark, sf_dir)
    if name in STANDINGS_SQL:
        return _standings(spark, sf_dir, name)
    source, where, projection = BRONZE_SQL[name]
    df = read_table(spark, sf_dir, source)
    if where:
        df = df.where(where)
    return df.selectExpr(*projection)


BRONZE_TABLES: tuple[str, ...] = tuple(sorted([*BRONZE_SQL, *STANDINGS_SQL, "race_data_seasons"]))
BRONZE_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    n: (lambda spark, sf_dir, _n=n: bronze(spark, sf_dir, _n)) for n in BRONZE_TABLES
}
