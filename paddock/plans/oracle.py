"""DuckDB SQL mirror of the registered Spark queries (the correctness oracle).

Each logical step is a named CTE with its dependencies; ``sql(final, *deps)``
assembles ``WITH`` clauses in dependency order. The CTEs restate the
bridge, the cleaning rules and the Gold models in plain SQL over the
provided tables, independently of the Spark code.
"""

from __future__ import annotations

SENT = r"'\N'"

# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


def sql(final: str, *deps: str) -> str:
    """WITH <deps in dependency order> <final>."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + final


# --------------------------------------------------------------------------
# helpers for bridge text
# --------------------------------------------------------------------------


def _duration_text(price: str, style: str) -> str:
    cents = f"CAST(floor(({price}) * 100) AS BIGINT)"
    secs = f"({cents} % 60)"
    frac = f"({cents} % 1000)"
    mins = f"(CAST(floor({cents} / 60) AS BIGINT) % 3 + 1)"
    return (
        f"CASE WHEN ({style}) = 0 THEN CAST({mins} AS VARCHAR) || ':' || lpad(CAST({secs} AS VARCHAR), 2, '0') || '.' || lpad(CAST({frac} AS VARCHAR), 3, '0') "
        f"WHEN ({style}) = 1 THEN CAST({secs} + 20 AS VARCHAR) || '.' || lpad(CAST({frac} AS VARCHAR), 3, '0') "
        f"WHEN ({style}) = 2 THEN CAST({mins} AS VARCHAR) || ':' || lpad(CAST({secs} AS VARCHAR), 2, '0') || '.' || CAST({frac} % 10 AS VARCHAR) "
        f"ELSE CAST({secs} + 60 AS VARCHAR) END"
    )


def _iso(days: int) -> str:
    return f"strftime(CAST(o_orderdate AS DATE) - {days}, '%Y-%m-%d')"


_POSITION_TEXT = (
    "CASE WHEN l_returnflag = 'R' THEN 'R' WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS VARCHAR) "
    "WHEN l_linestatus = 'O' THEN 'D' ELSE 'W' END"
)

_ACCIDENT_DATE = (
    "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
    "WHEN 1 THEN strftime(o_orderdate, '%m/%d/%y') WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%y') "
    "WHEN 3 THEN strftime(o_orderdate, '%-m/%d/%y') ELSE strftime(o_orderdate, '%m/%-d/%y') END"
)

# --------------------------------------------------------------------------
# Bronze (bridge)
# --------------------------------------------------------------------------

cte(
    "b_race_data_circuits",
    """SELECT c_custkey AS circuitid, lower(c_name) AS circuitref, '  ' || c_name || ' ' AS name,
  c_mktsegment AS location,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'UK' WHEN 'BUILDING' THEN 'USA' WHEN 'FURNITURE' THEN ' UAE '
    WHEN 'HOUSEHOLD' THEN 'Korea' ELSE 'Monaco' END AS country,
  c_acctbal / 100.0 AS lat, CAST(c_nationkey AS DOUBLE) * 2.5 AS lng, c_nationkey * 10 AS alt,
  'https://example.org/circuit/' || CAST(c_custkey AS VARCHAR) AS url
FROM customer""",
)

cte(
    "b_race_data_races",
    f"""SELECT o_orderkey AS raceid, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS round, o_custkey AS circuitid,
  o_orderpriority || ' Race ' || CAST(o_orderkey AS VARCHAR) AS name,
  {_iso(0)} AS date,
  CASE o_orderstatus WHEN 'F' THEN '14:00:00Z' WHEN 'O' THEN '9:30:00.000' ELSE {SENT} END AS time,
  {_iso(2)} AS fp1_date, '11:30:00' AS fp1_time,
  {_iso(2)} AS fp2_date, ' 15:00:00 ' AS fp2_time,
  CASE WHEN o_orderpriority = '1-URGENT' THEN {SENT} ELSE {_iso(1)} END AS fp3_date,
  CASE WHEN o_orderpriority = '1-URGENT' THEN {SENT} ELSE '11:30:00+01' END AS fp3_time,
  {_iso(1)} AS quali_date, '15:00:00' AS quali_time,
  CASE WHEN o_orderpriority = '1-URGENT' THEN {_iso(1)} ELSE {SENT} END AS sprint_date,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '10:30:00' ELSE {SENT} END AS sprint_time,
  'https://example.org/race/' || CAST(o_orderkey AS VARCHAR) AS url
FROM orders""",
)

cte(
    "b_race_data_drivers",
    f"""SELECT s_suppkey AS driverid, lower(s_name) AS driverref,
  CASE WHEN s_nationkey < 5 THEN {SENT} ELSE CAST(s_nationkey AS VARCHAR) END AS number,
  'S' || CAST(s_nationkey AS VARCHAR) AS code,
  ' ' || substr(s_name, 1, 8) AS forename, substr(s_name, 10) || ' ' AS surname,
  CASE WHEN s_nationkey < 10 THEN strftime(make_date(1960 + s_nationkey, 1 + s_nationkey % 12, 1 + s_nationkey), '%Y-%m-%d')
    WHEN s_nationkey < 15 THEN strftime(make_date(1960 + s_nationkey, 1 + s_nationkey % 12, 1 + s_nationkey), '%-m/%-d/%y')
    WHEN s_nationkey < 20 THEN strftime(make_date(1960 + s_nationkey, 1 + s_nationkey % 12, 1 + s_nationkey), '%m/%d/%y')
    ELSE 'unknown' END AS dob,
  CASE WHEN s_nationkey < 8 THEN 'UK' ELSE 'Nation ' || CAST(s_nationkey AS VARCHAR) END AS nationality,
  'https://example.org/driver/' || CAST(s_suppkey AS VARCHAR) AS url
FROM supplier""",
)

cte(
    "b_race_data_constructors",
    """SELECT p_partkey AS constructorid, lower(p_brand) AS constructorref, ' ' || p_name || ' ' AS name,
  p_type AS nationality, 'https://example.org/team/' || CAST(p_partkey AS VARCHAR) AS url
FROM part""",
)

cte("b_race_data_status", "SELECT n_nationkey AS statusid, n_name AS status FROM nation")

cte(
    "b_race_data_results",
    f"""SELECT l_orderkey * 10 + l_linenumber AS resultid, l_orderkey AS raceid, l_suppkey AS driverid,
  l_partkey AS constructorid, CAST(l_linenumber AS VARCHAR) AS number,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN {SENT} ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS grid,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS VARCHAR) END AS position,
  {_POSITION_TEXT} AS positiontext,
  l_linenumber AS positionorder, l_quantity AS points, CAST(floor(l_quantity) AS INTEGER) AS laps,
  '+' || CAST(l_linenumber AS VARCHAR) || '.000' AS time,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS VARCHAR) END AS milliseconds,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber + 40 AS VARCHAR) END AS fastestlap,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS VARCHAR) END AS rank,
  {_duration_text('l_extendedprice', "CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE 2 END")} AS fastestlaptime,
  CAST(CAST(200 + l_discount * 100 AS DECIMAL(8,3)) AS VARCHAR) AS fastestlapspeed,
  l_linenumber AS statusid
FROM lineitem""",
)

cte(
    "b_race_data_sprint_results",
    f"""SELECT l_orderkey AS raceid, l_suppkey AS driverid, l_partkey AS constructorid,
  CAST(l_linenumber AS VARCHAR) AS number, CAST(l_linenumber AS VARCHAR) AS grid,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber AS VARCHAR) END AS position,
  {_POSITION_TEXT} AS positiontext,
  l_linenumber AS positionorder, round(l_tax * 100) AS points, CAST(floor(l_quantity / 2) AS INTEGER) AS laps,
  '+1.5' AS time,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(CAST(floor(l_extendedprice * 10) AS BIGINT) AS VARCHAR) END AS milliseconds,
  CASE WHEN l_returnflag = 'R' THEN {SENT} ELSE CAST(l_linenumber + 10 AS VARCHAR) END AS fastestlap,
  CASE WHEN l_returnflag = 'R' THEN '-' ELSE CAST(l_linenumber AS VARCHAR) END AS rank,
  {_duration_text('l_extendedprice + l_tax', "CASE WHEN l_linestatus = 'F' THEN 0 ELSE 3 END")} AS fastestlaptime,
  l_linenumber AS statusid
FROM lineitem""",
)

cte(
    "b_race_data_qualifying",
    f"""SELECT l_orderkey AS raceid, l_suppkey AS driverid, l_partkey AS constructorid,
  CAST(l_linenumber AS VARCHAR) AS number, CAST(l_linenumber AS VARCHAR) AS position,
  {_duration_text('l_extendedprice', '0')} AS q1,
  {_duration_text('l_extendedprice + 1', "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END")} AS q2,
  CASE WHEN l_returnflag = 'A' THEN {_duration_text('l_extendedprice + 2', '0')} ELSE {SENT} END AS q3
FROM lineitem""",
)

cte(
    "b_race_data_lap_times",
    f"""SELECT l_orderkey AS raceid, l_suppkey AS driverid, l_linenumber AS lap,
  CAST(l_linenumber AS VARCHAR) AS position, {_duration_text('l_extendedprice', '0')} AS time,
  CAST(CAST(floor(l_extendedprice * 3) AS BIGINT) AS VARCHAR) AS milliseconds
FROM lineitem""",
)

cte(
    "b_race_data_pit_stops",
    f"""SELECT l_orderkey AS raceid, l_suppkey AS driverid, l_linenumber AS stop,
  CAST(floor(l_quantity) AS INTEGER) AS lap,
  CAST(12 + l_linenumber AS VARCHAR) || ':' || lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR), 2, '0')
    || CASE WHEN l_linestatus = 'O' THEN '.123' ELSE '' END AS time,
  {_duration_text('l_discount * 1000 + l_tax * 100', "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 0 ELSE 3 END")} AS duration,
  CAST(CAST(floor(l_discount * 100000) AS BIGINT) AS VARCHAR) AS milliseconds
FROM lineitem""",
)

cte(
    "b_race_data_driver_standings",
    f"""SELECT l_orderkey AS raceid, l_suppkey AS driverid,
  CAST(floor(max(l_extendedprice) / 10) AS DOUBLE) / 100 AS points,
  CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN {SENT} ELSE CAST(min(l_linenumber) AS VARCHAR) END AS position,
  CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN '-' ELSE CAST(min(l_linenumber) AS VARCHAR) END AS positiontext,
  max(CAST(round(l_discount * 100) AS INTEGER)) AS wins
FROM lineitem GROUP BY l_orderkey, l_suppkey""",
)

cte(
    "b_race_data_constructor_standings",
    """SELECT l_orderkey AS raceid, l_partkey AS constructorid, max(l_quantity) AS points,
  CAST(min(l_linenumber) AS VARCHAR) AS position,
  CASE WHEN count(*) FILTER (WHERE l_linestatus = 'F') > 0 THEN 'E' ELSE CAST(min(l_linenumber) AS VARCHAR) END AS positiontext,
  max(CAST(round(l_tax * 100) AS INTEGER)) AS wins
FROM lineitem GROUP BY l_orderkey, l_partkey""",
)

cte(
    "b_race_data_constructor_results",
    f"""SELECT l_orderkey AS raceid, l_partkey AS constructorid,
  CASE WHEN l_returnflag = 'R' THEN 'D' ELSE {SENT} END AS status
FROM lineitem""",
)

cte("b_race_data_seasons", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")

cte(
    "b_race_events_safety_cars",
    """SELECT 'Race ' || CAST(user_id AS VARCHAR) AS race,
  CASE WHEN event_type = 'error' THEN 'Accident/Debris'
    WHEN event_type = 'click' AND value > 10 THEN 'Multiple accidents'
    WHEN event_type = 'click' THEN 'Stranded car/Rain'
    WHEN value > 10 THEN 'debris on track' ELSE ' Rain ' END AS cause,
  CAST(floor(value) AS INTEGER) AS deployed, value + 3.0 AS retreated,
  CAST(floor(value / 2) AS INTEGER) AS fulllaps
FROM events WHERE event_type IN ('error', 'click', 'view')""",
)

cte(
    "b_race_events_red_flags",
    f"""SELECT 'Race ' || CAST(user_id AS VARCHAR) AS race, CAST(floor(value) AS INTEGER) AS lap,
  'Incident ' || CAST(event_id AS VARCHAR) AS incident,
  CASE WHEN value < 5 THEN 'R' WHEN value < 10 THEN 'S' WHEN value < 15 THEN 'Y' WHEN value < 20 THEN 'N' ELSE {SENT} END AS resumed,
  CASE WHEN event_type = 'signup' THEN 'Driver ' || CAST(user_id AS VARCHAR) ELSE '-' END AS excluded
FROM events WHERE event_type IN ('purchase', 'signup')""",
)

cte(
    "b_race_events_fatal_accidents_drivers",
    f"""SELECT ' Driver ' || CAST(o_custkey AS VARCHAR) AS driver, CAST(month(o_orderdate) + 20 AS INTEGER) AS age,
  {_ACCIDENT_DATE} AS date_of_accident,
  CAST(year(o_orderdate) AS VARCHAR) || ' ' || o_orderpriority || ' Race' AS event,
  'Car ' || CAST(o_custkey AS VARCHAR) AS car,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Practice' ELSE 'Race' END AS session
FROM orders WHERE o_orderstatus = 'F'""",
)

cte(
    "b_race_events_fatal_accidents_marshalls",
    f"""SELECT 'Marshal ' || CAST(o_orderkey AS VARCHAR) AS name, CAST(day(o_orderdate) + 18 AS INTEGER) AS age,
  {_ACCIDENT_DATE} AS date_of_accident,
  CAST(year(o_orderdate) AS VARCHAR) || ' ' || o_orderpriority || ' Race' AS event
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""",
)

# --------------------------------------------------------------------------
# Silver cleaning expressions
# --------------------------------------------------------------------------

DATA_MAP = [
    ("R", "'Retired'"), ("D", "'Disqualified'"), ("E", "'Excluded'"), ("F", "'Failed'"),
    ("N", "'Not Classified'"), ("W", "'Withdrawn'"), ("\\N", "NULL"), ("-", "NULL"),
    ("USA", "'United States'"), ("UK", "'United Kingdom'"), ("UAE", "'United Arab Emirates'"),
    ("Korea", "'South Korea'"),
]
EVENTS_MAP = [
    ("R", "'Resumed'"), ("S", "'Standing Start'"), ("Y", "'Rolling Start'"), ("N", "'Not Resumed'"),
    ("\\N", "NULL"), ("-", "NULL"),
]


def mapped(x: str, events: bool = False) -> str:
    """trim + whole-value map of a string expression."""
    t = f"trim({x})"
    whens = " ".join(f"WHEN {t} = '{k}' THEN {v}" for k, v in (EVENTS_MAP if events else DATA_MAP))
    return f"(CASE {whens} ELSE {t} END)"


def as_int(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS INTEGER) END)"


def as_date(x: str) -> str:
    short = f"CAST(try_strptime({x}, '%m/%d/%y') AS DATE)"
    return (
        f"(CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_full_match({x}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}') THEN "
        f"(CASE WHEN {short} > DATE '2029-12-31' THEN CAST({short} - INTERVAL 100 YEAR AS DATE) ELSE {short} END) END)"
    )


def ms(x: str) -> str:
    parts = f"string_split({x}, ':')"
    last = f"{parts}[-1]"
    n = f"len({parts})"
    total = (
        f"(CASE WHEN {n} >= 3 THEN CAST({parts}[-3] AS BIGINT) ELSE 0 END) * 3600000 + "
        f"(CASE WHEN {n} >= 2 THEN CAST({parts}[-2] AS BIGINT) ELSE 0 END) * 60000 + "
        f"CAST(split_part({last}, '.', 1) AS BIGINT) * 1000 + CAST(rpad(split_part({last}, '.', 2), 3, '0') AS BIGINT)"
    )
    return f"(CASE WHEN regexp_full_match({x}, '([0-9]+:){{0,2}}[0-9]+([.][0-9]{{1,3}})?') THEN TRY_CAST({total} AS INTEGER) END)"


def clock(x: str) -> str:
    return f"regexp_replace({x}, '([0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}).*', '\\1')"


def cause(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, '(?i).*accident.*') THEN 'Accident(s)' "
        f"WHEN regexp_matches({x}, '(?i).*stranded car.*') THEN 'Stranded Car(s)' "
        f"WHEN regexp_matches({x}, '(?i).*debris.*') THEN 'Debris' ELSE {x} END)"
    )


M = mapped

cte(
    "s_race_data_circuits",
    f"""SELECT circuitid, {M('circuitref')} AS circuitref, {M('name')} AS name, {M('location')} AS location,
  {M('country')} AS country, lat, lng, alt
FROM b_race_data_circuits""",
    "b_race_data_circuits",
)

_race_dates = ["date", "fp1_date", "fp2_date", "fp3_date", "quali_date", "sprint_date"]
cte(
    "s_race_data_races",
    "SELECT raceid, round, circuitid, " + f"{M('name')} AS name, "
    + ", ".join(
        f"{as_date(M(d))} AS {d}, {clock(M(d.replace('date', 'time')))} AS {d.replace('date', 'time')}"
        for d in _race_dates
    )
    + "\nFROM b_race_data_races",
    "b_race_data_races",
)

cte(
    "s_race_data_drivers",
    f"""SELECT driverid, {M('driverref')} AS driverref, {as_int(M('number'))} AS number, {M('code')} AS code,
  {M('forename')} AS forename, {M('surname')} AS surname, {as_date(M('dob'))} AS dob, {M('nationality')} AS nationality
FROM b_race_data_drivers""",
    "b_race_data_drivers",
)

cte(
    "s_race_data_constructors",
    f"""SELECT constructorid, {M('constructorref')} AS constructorref, {M('name')} AS name, {M('nationality')} AS nationality
FROM b_race_data_constructors""",
    "b_race_data_constructors",
)

cte("s_race_data_status", f"SELECT statusid, {M('status')} AS status FROM b_race_data_status", "b_race_data_status")

cte(
    "s_race_data_results",
    f"""SELECT resultid, raceid, driverid, constructorid, {as_int(M('number'))} AS number, {as_int(M('grid'))} AS grid,
  {as_int(M('position'))} AS position, {M('positiontext')} AS positiontext, positionorder, points, laps,
  {as_int(M('milliseconds'))} AS milliseconds, TRY_CAST({M('fastestlap')} AS INTEGER) AS fastestlap,
  {as_int(M('rank'))} AS rank, {ms(M('fastestlaptime'))} AS fastestlaptime,
  TRY_CAST({M('fastestlapspeed')} AS DOUBLE) AS fastestlapspeed, statusid
FROM b_race_data_results""",
    "b_race_data_results",
)

cte(
    "s_race_data_sprint_results",
    f"""SELECT raceid, driverid, constructorid, {as_int(M('number'))} AS number, {as_int(M('grid'))} AS grid,
  {as_int(M('position'))} AS position, {M('positiontext')} AS positiontext, positionorder, points, laps,
  {as_int(M('milliseconds'))} AS milliseconds, {as_int(M('fastestlap'))} AS fastestlap, {as_int(M('rank'))} AS rank,
  {ms(M('fastestlaptime'))} AS fastestlaptime, statusid
FROM b_race_data_sprint_results""",
    "b_race_data_sprint_results",
)

cte(
    "s_race_data_qualifying",
    f"""SELECT raceid, driverid, constructorid, {as_int(M('number'))} AS number, {as_int(M('position'))} AS position,
  {ms(M('q1'))} AS q1, {ms(M('q2'))} AS q2, {ms(M('q3'))} AS q3
FROM b_race_data_qualifying""",
    "b_race_data_qualifying",
)

cte(
    "s_race_data_lap_times",
    f"""SELECT raceid, driverid, lap, {as_int(M('position'))} AS position, {as_int(M('milliseconds'))} AS milliseconds
FROM b_race_data_lap_times""",
    "b_race_data_lap_times",
)

cte(
    "s_race_data_pit_stops",
    f"""SELECT raceid, driverid, stop, lap, {clock(M('time'))} AS time, {ms(M('duration'))} AS duration,
  {as_int(M('milliseconds'))} AS milliseconds
FROM b_race_data_pit_stops""",
    "b_race_data_pit_stops",
)

cte(
    "s_race_data_driver_standings",
    f"""SELECT raceid, driverid, points, {as_int(M('position'))} AS position, {M('positiontext')} AS positiontext, wins
FROM b_race_data_driver_standings""",
    "b_race_data_driver_standings",
)

cte(
    "s_race_data_constructor_standings",
    f"""SELECT raceid, constructorid, points, {as_int(M('position'))} AS position, {M('positiontext')} AS positiontext, wins
FROM b_race_data_constructor_standings""",
    "b_race_data_constructor_standings",
)

cte(
    "s_race_data_constructor_results",
    f"SELECT raceid, constructorid, {M('status')} AS status FROM b_race_data_constructor_results",
    "b_race_data_constructor_results",
)

cte("s_race_data_seasons", "SELECT make_date(year, 1, 1) AS year FROM b_race_data_seasons", "b_race_data_seasons")

cte(
    "s_race_events_safety_cars",
    f"""SELECT {M('race', True)} AS race, {cause(M('cause', True))} AS cause, deployed, retreated, fulllaps
FROM b_race_events_safety_cars""",
    "b_race_events_safety_cars",
)

cte(
    "s_race_events_red_flags",
    f"""SELECT {M('race', True)} AS race, lap, {M('incident', True)} AS incident, {M('resumed', True)} AS resumed,
  {M('excluded', True)} AS excluded
FROM b_race_events_red_flags""",
    "b_race_events_red_flags",
)

cte(
    "s_race_events_fatal_accidents_drivers",
    f"""SELECT {M('driver', True)} AS driver, age, {as_date(M('date_of_accident', True))} AS date_of_accident,
  {M('event', True)} AS event, {M('car', True)} AS car, {M('session', True)} AS session
FROM b_race_events_fatal_accidents_drivers""",
    "b_race_events_fatal_accidents_drivers",
)

cte(
    "s_race_events_fatal_accidents_marshalls",
    f"""SELECT {M('name', True)} AS name, age, {as_date(M('date_of_accident', True))} AS date_of_accident,
  {M('event', True)} AS event
FROM b_race_events_fatal_accidents_marshalls""",
    "b_race_events_fatal_accidents_marshalls",
)

# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------

cte(
    "dim_circuits",
    """SELECT circuitid AS circuit_id, circuitref AS circuit_ref, name AS circuit_name, location AS city, country,
  lat AS latitude, lng AS longitude, alt AS altitude_meters FROM s_race_data_circuits""",
    "s_race_data_circuits",
)
cte(
    "dim_drivers",
    """SELECT driverid AS driver_id, driverref AS driver_ref, number AS driver_number, code AS driver_code,
  forename AS first_name, surname AS last_name, forename || ' ' || surname AS driver_full_name,
  dob AS date_of_birth, nationality FROM s_race_data_drivers""",
    "s_race_data_drivers",
)
cte(
    "dim_races",
    """SELECT raceid AS race_id, CAST(year(date) AS VARCHAR) || '_' || replace(name, ' ', '_') AS race_key,
  CAST(year(date) AS INTEGER) AS year, name AS race_name, round, date AS race_date, time AS race_time,
  circuitid AS circuit_id, fp1_date, fp1_time, fp2_date, fp2_time, fp3_date, fp3_time,
  quali_date, quali_time, sprint_date, sprint_time FROM s_race_data_races""",
    "s_race_data_races",
)
cte(
    "dim_teams",
    """SELECT constructorid AS team_id, constructorref AS team_ref, name AS team_name, nationality
FROM s_race_data_constructors""",
    "s_race_data_constructors",
)

_RD = "JOIN dim_races r ON x.raceid = r.race_id JOIN s_race_data_drivers d ON x.driverid = d.driverid"
_NAME = "d.forename || ' ' || d.surname AS driver_full_name"

cte(
    "fact_lap_times",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, x.lap, x.position AS lap_position,
  x.milliseconds AS lap_time_ms, r.race_id
FROM s_race_data_lap_times x {_RD}""",
    "s_race_data_lap_times", "dim_races", "s_race_data_drivers",
)
cte(
    "fact_pit_stops",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, x.stop AS stop_number, x.lap,
  x.duration AS duration_ms, r.race_id
FROM s_race_data_pit_stops x {_RD}""",
    "s_race_data_pit_stops", "dim_races", "s_race_data_drivers",
)
cte(
    "fact_qualifying",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, t.name AS team_name,
  x.constructorid AS team_id, x.number AS car_number, x.position AS qualifying_position,
  x.q1 AS q1_ms, x.q2 AS q2_ms, x.q3 AS q3_ms, r.race_id
FROM s_race_data_qualifying x {_RD} JOIN s_race_data_constructors t ON x.constructorid = t.constructorid""",
    "s_race_data_qualifying", "dim_races", "s_race_data_drivers", "s_race_data_constructors",
)
cte(
    "pit_aggregates",
    """SELECT race_id, driver_id, count(*) AS pit_stop_count, CAST(sum(duration_ms) AS BIGINT) AS total_pit_time_ms
FROM fact_pit_stops GROUP BY race_id, driver_id""",
    "fact_pit_stops",
)
cte(
    "fact_results",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, t.name AS team_name,
  x.constructorid AS team_id, x.number AS car_number, x.grid AS grid_position, x.position AS finish_position,
  x.positionorder AS position_order, x.points, x.laps, x.milliseconds AS race_time_ms,
  x.fastestlap AS fastest_lap_number, x.rank AS fastest_lap_rank, x.fastestlapspeed AS fastest_lap_speed,
  s.status, CASE WHEN NOT regexp_matches(x.positiontext, '^[0-9]+$') THEN true ELSE false END AS dnf_flag,
  x.grid - x.positionorder AS positions_gained,
  coalesce(pa.pit_stop_count, 0) AS pit_stop_count, coalesce(pa.total_pit_time_ms, 0) AS total_pit_time_ms,
  r.race_id
FROM s_race_data_results x {_RD}
JOIN s_race_data_constructors t ON x.constructorid = t.constructorid
JOIN s_race_data_status s ON x.statusid = s.statusid
LEFT JOIN pit_aggregates pa ON r.race_id = pa.race_id AND x.driverid = pa.driver_id""",
    "s_race_data_results", "dim_races", "s_race_data_drivers", "s_race_data_constructors",
    "s_race_data_status", "pit_aggregates",
)
cte(
    "fact_sprint_results",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, t.name AS team_name,
  x.constructorid AS team_id, x.number AS car_number, x.grid AS grid_position, x.position AS finish_position,
  x.positionorder AS position_order, x.points, x.laps, x.milliseconds AS race_time_ms,
  x.fastestlap AS fastest_lap_number, x.fastestlaptime AS fastest_lap_time_ms,
  s.status, CASE WHEN NOT regexp_matches(x.positiontext, '^[0-9]+$') THEN true ELSE false END AS dnf_flag,
  x.grid - x.positionorder AS positions_gained, r.race_id
FROM s_race_data_sprint_results x {_RD}
JOIN s_race_data_constructors t ON x.constructorid = t.constructorid
JOIN s_race_data_status s ON x.statusid = s.statusid""",
    "s_race_data_sprint_results", "dim_races", "s_race_data_drivers", "s_race_data_constructors",
    "s_race_data_status",
)
cte(
    "standings_drivers",
    f"""SELECT r.race_key, r.year, {_NAME}, x.driverid AS driver_id, x.points, x.position, x.wins, r.race_id
FROM s_race_data_driver_standings x {_RD}""",
    "s_race_data_driver_standings", "dim_races", "s_race_data_drivers",
)
cte(
    "standings_teams",
    """SELECT r.race_key, r.year, t.name AS team_name, x.constructorid AS team_id, x.points, x.position, x.wins, r.race_id
FROM s_race_data_constructor_standings x JOIN dim_races r ON x.raceid = r.race_id
JOIN s_race_data_constructors t ON x.constructorid = t.constructorid""",
    "s_race_data_constructor_standings", "dim_races", "s_race_data_constructors",
)
cte(
    "event_race_incidents",
    """SELECT race AS race_name, 'Safety Car' AS incident_type, CAST(NULL AS INTEGER) AS lap, cause AS incident,
  deployed AS deployed_lap, CAST(retreated AS DOUBLE) AS retreated_lap, fulllaps AS full_laps_under_sc,
  CAST(NULL AS VARCHAR) AS resumed, CAST(NULL AS VARCHAR) AS excluded
FROM s_race_events_safety_cars
UNION ALL
SELECT race, 'Red Flag', lap, incident, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER),
  resumed, excluded
FROM s_race_events_red_flags""",
    "s_race_events_safety_cars", "s_race_events_red_flags",
)
cte(
    "event_fatal_accidents",
    """SELECT driver AS name, age, date_of_accident, event, car, session, 'Driver' AS type
FROM s_race_events_fatal_accidents_drivers
UNION ALL
SELECT name, age, date_of_accident, event, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'Marshal'
FROM s_race_events_fatal_accidents_marshalls""",
    "s_race_events_fatal_accidents_drivers", "s_race_events_fatal_accidents_marshalls",
)

# --------------------------------------------------------------------------
# Views
# --------------------------------------------------------------------------


def _master_select() -> str:
    from .views import MASTER_COLUMNS

    return ",\n  ".join(f'{src} AS "{name}"' for src, name in MASTER_COLUMNS)


cte(
    "historical_master",
    f"""SELECT
  {_master_select()}
FROM fact_results fr
JOIN dim_races r ON fr.race_id = r.race_id
JOIN dim_circuits c ON r.circuit_id = c.circuit_id
JOIN dim_drivers d ON fr.driver_id = d.driver_id
JOIN dim_teams t ON fr.team_id = t.team_id
LEFT JOIN standings_drivers sd ON fr.race_id = sd.race_id AND fr.driver_id = sd.driver_id
LEFT JOIN standings_teams st ON fr.race_id = st.race_id AND fr.team_id = st.team_id""",
    "fact_results", "dim_races", "dim_circuits", "dim_drivers", "dim_teams", "standings_drivers",
    "standings_teams",
)


def quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


cte(
    "historical_incidents",
    """SELECT race_name AS "Race Name", incident_type AS "Incident Type", lap AS "Lap",
  incident AS "Incident Description", deployed_lap AS "SC Deployed Lap", retreated_lap AS "SC Retreated Lap",
  full_laps_under_sc AS "Full Laps Under SC", resumed AS "Resumed", excluded AS "Excluded Drivers",
  CAST(NULL AS VARCHAR) AS "Person", CAST(NULL AS INTEGER) AS "Age", CAST(NULL AS DATE) AS "Date of Accident",
  CAST(NULL AS VARCHAR) AS "Car", CAST(NULL AS VARCHAR) AS "Session", CAST(NULL AS VARCHAR) AS "Fatal Accident Type"
FROM event_race_incidents
UNION ALL
SELECT event, 'Fatal Accident', CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER),
  CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  name, CAST(age AS INTEGER), date_of_accident, car, session, type
FROM event_fatal_accidents""",
    "event_race_incidents", "event_fatal_accidents",
)


def select_all(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)
