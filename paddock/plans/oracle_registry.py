"""Oracle SQL per registered query key (DuckDB over the provided tables)."""

from __future__ import annotations

from ..sources.registry import SOURCE_TABLES
from . import oracle as o
from . import oracle_checks as _c
from .gold import GOLD_MODELS
from .views import DRIVERS_TEAMS_COLUMNS, OVERVIEW_COLUMNS, SEASON_COLUMNS

ORACLE: dict[str, str] = {}

ORACLE["historical_master"] = o.select_all("historical_master")
ORACLE["historical_overview"] = o.sql(f"SELECT {o.quoted(OVERVIEW_COLUMNS)} FROM historical_master", "historical_master")
ORACLE["historical_drivers_teams"] = o.sql(
    f"SELECT {o.quoted(DRIVERS_TEAMS_COLUMNS)} FROM historical_master", "historical_master"
)
ORACLE["historical_seasons"] = o.sql(
    f"SELECT DISTINCT {o.quoted(SEASON_COLUMNS)} FROM historical_master", "historical_master"
)
ORACLE["historical_incidents"] = o.select_all("historical_incidents")

# --- Silver tables and single rules ---------------------------------------------


for _t in SOURCE_TABLES:
    ORACLE[f"silver_{_t}"] = o.select_all(f"s_{_t}")

ORACLE["rule_trim_strings"] = o.sql(
    """SELECT circuitid, trim(circuitref) AS circuitref, trim(name) AS name, trim(location) AS location,
  trim(country) AS country, lat, lng, alt, trim(url) AS url FROM b_race_data_circuits""",
    "b_race_data_circuits",
)
_M = o.mapped
ORACLE["rule_value_map"] = o.sql(
    f"""SELECT resultid, raceid, driverid, constructorid, {_M('number')} AS number, {_M('grid')} AS grid,
  {_M('position')} AS position, {_M('positiontext')} AS positiontext, positionorder, points, laps,
  {_M('time')} AS time, {_M('milliseconds')} AS milliseconds, {_M('fastestlap')} AS fastestlap,
  {_M('rank')} AS rank, {_M('fastestlaptime')} AS fastestlaptime, {_M('fastestlapspeed')} AS fastestlapspeed,
  statusid FROM b_race_data_results""",
    "b_race_data_results",
)
ORACLE["rule_event_map"] = o.sql(
    f"""SELECT {_M('race', True)} AS race, lap, {_M('incident', True)} AS incident,
  {_M('resumed', True)} AS resumed, {_M('excluded', True)} AS excluded FROM b_race_events_red_flags""",
    "b_race_events_red_flags",
)
ORACLE["rule_multi_format_date"] = o.sql(
    f"""SELECT date_of_accident AS date_text, {o.as_date('date_of_accident')} AS date_of_accident
FROM b_race_events_fatal_accidents_drivers""",
    "b_race_events_fatal_accidents_drivers",
)
ORACLE["rule_safe_int_cast"] = o.sql(
    "SELECT resultid, "
    + ", ".join(f"{o.as_int(_M(c))} AS {c}" for c in ("milliseconds", "position", "number", "grid", "rank"))
    + " FROM b_race_data_results",
    "b_race_data_results",
)
ORACLE["rule_time_to_ms"] = o.sql(
    f"SELECT raceid, driverid, q1, q2, {o.ms('q1')} AS q1_ms, {o.ms('q2')} AS q2_ms FROM b_race_data_qualifying",
    "b_race_data_qualifying",
)
ORACLE["rule_wall_clock"] = o.sql(
    f"SELECT raceid, driverid, stop, time AS time_text, {o.clock('time')} AS wall_clock FROM b_race_data_pit_stops",
    "b_race_data_pit_stops",
)
ORACLE["rule_cause_normalise"] = o.sql(
    f"SELECT cause AS cause_text, {o.cause('cause')} AS cause FROM b_race_events_safety_cars",
    "b_race_events_safety_cars",
)


def _ts(d: str, t: str) -> str:
    return f"try_strptime(CAST({d} AS VARCHAR) || ' ' || {t}, '%Y-%m-%d %H:%M:%S')"


ORACLE["session_timestamps"] = o.sql(
    "SELECT raceid, "
    + ", ".join(
        [f"{_ts('date', 'time')} AS race_timestamp"]
        + [f"{_ts(p + '_date', p + '_time')} AS {p}_timestamp" for p in ("fp1", "fp2", "fp3", "quali", "sprint")]
    )
    + " FROM s_race_data_races",
    "s_race_data_races",
)

# --- quality reports ------------------------------------------------------------------


def _dlit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _dfail(chk) -> str | None:
    c = f'"{chk.column}"'
    txt = f"CAST({c} AS VARCHAR)"
    if chk.kind == "not_null":
        return f"{c} IS NULL"
    if chk.kind == "in_set":
        return f"{c} IS NOT NULL AND NOT ({c} IN ({', '.join(_dlit(v) for v in chk.arg)}))"
    if chk.kind == "not_match":
        return f"{c} IS NOT NULL AND regexp_matches({txt}, {_dlit(chk.arg)})"
    if chk.kind == "match":
        return f"{c} IS NOT NULL AND NOT regexp_matches({txt}, {_dlit(chk.arg)})"
    if chk.kind == "between":
        return f"{c} IS NOT NULL AND NOT ({c} BETWEEN {chk.arg[0]} AND {chk.arg[1]})"
    return None


_DUCK_TYPE = {"int": "INTEGER", "double": "DOUBLE"}


def _has_column(cte_name: str, column: str) -> bool:
    import re

    body = o.CTES[cte_name][0]
    return re.search(rf"\bAS {column}\b(?!\s*\))", body) is not None or re.search(
        rf"(SELECT|,)\s*{column}\s*(,|\n|FROM)", body
    ) is not None


def _dq_table(prefix: str, table: str) -> tuple[str, list[str]]:
    cte_name = f"{prefix}_{table}"
    aggs, rows = [], []
    for i, chk in enumerate([e for e in _c.SILVER if e.table == table]):
        meta = f"{_dlit(table)} AS table_name, {_dlit(_c.NAMES[chk.kind])} AS check_name, {_dlit(chk.column)} AS column_name"
        hint = _dlit(_c.rule(chk))
        if chk.kind == "absent":
            ok = "false" if _has_column(cte_name, chk.column) else "true"
            rows.append(f"SELECT {meta}, CAST(NULL AS BIGINT) AS unexpected_count, {ok} AS success, "
                        f"{hint} AS rule, CAST(NULL AS VARCHAR) AS first_example")
        elif chk.kind == "of_type":
            want = _DUCK_TYPE[chk.arg]
            rows.append(f"SELECT {meta}, CAST(NULL AS BIGINT) AS unexpected_count, coalesce((SELECT typeof(\"{chk.column}\") FROM {cte_name} LIMIT 1) = '{want}', false) AS success, "
                        f"{hint} AS rule, CAST(NULL AS VARCHAR) AS first_example")
        else:
            f = _dfail(chk)
            aggs.append(f"count_if({f}) AS n{i}, min(CASE WHEN {f} THEN CAST(\"{chk.column}\" AS VARCHAR) END) AS x{i}")
            rows.append(f"SELECT {meta}, n{i} AS unexpected_count, n{i} = 0 AS success, {hint} AS rule, x{i} AS first_example FROM agg_{cte_name}")
    if aggs:
        o.cte(f"agg_{cte_name}", f"SELECT {', '.join(aggs)} FROM {cte_name}", cte_name)
    return "\nUNION ALL\n".join(rows), ([f"agg_{cte_name}"] if aggs else []) + [cte_name]


def _dq_report(prefix: str) -> tuple[str, list[str]]:
    selects, deps = [], []
    for t in SOURCE_TABLES:
        s, d = _dq_table(prefix, t)
        selects.append(s)
        deps += d
    return "\nUNION ALL\n".join(selects), deps


_silver_body, _silver_deps = _dq_report("s")
_bronze_body, _bronze_deps = _dq_report("b")
o.cte("dq_bronze", _bronze_body, *_bronze_deps)
ORACLE["dq_silver_report"] = o.sql(_silver_body, *_silver_deps)
ORACLE["dq_bronze_report"] = o.sql("SELECT * FROM dq_bronze", "dq_bronze")
ORACLE["dq_table_verdicts"] = o.sql(
    """SELECT table_name, bool_and(success) AS passed, count_if(NOT success) AS failed_checks, count(*) AS checks
FROM dq_bronze GROUP BY table_name""",
    "dq_bronze",
)


def _examples() -> tuple[str, list[str]]:
    parts, deps = [], []
    for t in SOURCE_TABLES:
        cte_name = f"b_{t}"
        for chk in [e for e in _c.SILVER if e.table == t]:
            f = _dfail(chk)
            if f is None or chk.kind == "not_null":
                continue
            parts.append(
                f"SELECT {_dlit(t)} AS table_name, {_dlit(_c.NAMES[chk.kind])} AS check_name, "
                f"{_dlit(chk.column)} AS column_name, string_agg(v, ', ' ORDER BY v) AS examples "
                f"FROM (SELECT CAST(\"{chk.column}\" AS VARCHAR) AS v FROM {cte_name} WHERE {f} ORDER BY v LIMIT 5) "
                f"HAVING count(*) > 0"
            )
            deps.append(cte_name)
    return "\nUNION ALL\n".join(parts), deps


_ex_body, _ex_deps = _examples()
ORACLE["dq_failure_examples"] = o.sql(_ex_body, *_ex_deps)

# --- ingest, layers, upserts, partitioned writes ------------------------------------------

ORACLE["csv_roundtrip"] = o.sql(
    """SELECT circuitid AS circuit_id, circuitref, name, location AS "location_city_", country, lat, lng,
  alt AS alt_meters, url FROM b_race_data_circuits""",
    "b_race_data_circuits",
)
ORACLE["sanitize_columns"] = (
    'SELECT l_orderkey AS "l_order_key_", l_linenumber AS "l_line_number", l_quantity AS "l_quantity" FROM lineitem'
)
ORACLE["ingest_report"] = """SELECT 'succeeded' AS status, 'orders.csv' AS file_name, 'landing_orders' AS table_name,
  false AS has_message, (SELECT count(*) FROM orders) AS row_count
UNION ALL SELECT 'skipped', 'nation.csv', 'landing_nation', false, CAST(NULL AS BIGINT)
UNION ALL SELECT 'failed', 'region.csv', 'landing_region', true, CAST(NULL AS BIGINT)
UNION ALL SELECT 'unlisted', 'missing', CAST(NULL AS VARCHAR), true, CAST(NULL AS BIGINT)"""
ORACLE["ingest_summary"] = """SELECT s AS status, CAST(1 AS BIGINT) AS files, CAST(0 AS BIGINT) AS rejected_rows,
  CAST(0 AS BIGINT) AS rejected_cells FROM (VALUES ('succeeded'), ('skipped'), ('failed'), ('unlisted')) t(s)"""
ORACLE["csv_rejects"] = o.sql(
    """SELECT 'succeeded' AS status, 'race_data_pit_stops' AS table_name, CAST(count_if(driverid % 7 = 0) AS BIGINT) AS rejected_rows,
  CAST(count_if(driverid % 7 = 0) AS BIGINT) AS rejected_cells, CAST(NULL AS VARCHAR) AS error,
  count(stop) FILTER (WHERE driverid % 7 <> 0) AS n_stops, CAST(sum(lap) AS BIGINT) AS sum_laps,
  CAST(sum(driverid) AS BIGINT) AS sum_drivers FROM b_race_data_pit_stops
UNION ALL SELECT 'failed', 'race_data_status', 0, 0, 'HeaderMismatch', NULL, NULL, NULL""",
    "b_race_data_pit_stops",
)
_RAGGED_CELLS = ["raceid", "driverid", "CASE WHEN driverid % 7 = 0 THEN 'one' ELSE CAST(stop AS VARCHAR) END", "lap",
                 "CASE WHEN driverid % 17 = 0 THEN '\"at' || chr(10) || coalesce(time, '') || '\"' ELSE time END", "duration"]
_RAGGED_SHORT = " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _RAGGED_CELLS)
_RAGGED_FULL = _RAGGED_SHORT + " || ',' || coalesce(CAST(milliseconds AS VARCHAR), '')"
ORACLE["csv_quarantine"] = o.sql(
    f"""SELECT CASE WHEN driverid % 11 = 0 THEN {_RAGGED_FULL} || ',EXTRA, CELLS' WHEN driverid % 13 = 0 THEN {_RAGGED_SHORT} ELSE {_RAGGED_FULL} END AS record,
  CASE WHEN driverid % 11 = 0 THEN 9 WHEN driverid % 13 = 0 THEN 6 ELSE 7 END AS n_cells, CAST(driverid % 7 = 0 AS INTEGER) AS rejected_cells,
  CASE WHEN driverid % 11 = 0 THEN 'extra cells' WHEN driverid % 13 = 0 THEN 'missing cells' ELSE 'bad cells' END AS reason
FROM b_race_data_pit_stops WHERE driverid % 11 = 0 OR driverid % 13 = 0 OR driverid % 7 = 0""",
    "b_race_data_pit_stops",
)
ORACLE["csv_ragged_rows"] = o.sql(
    """SELECT raceid, driverid, CASE WHEN driverid % 7 <> 0 THEN stop END AS stop, lap,
  CASE WHEN driverid % 17 = 0 THEN 'at' || chr(10) || coalesce(time, '') ELSE time END AS time, duration,
  CASE WHEN driverid % 13 <> 0 OR driverid % 11 = 0 THEN milliseconds END AS milliseconds FROM b_race_data_pit_stops""",
    "b_race_data_pit_stops",
)
ORACLE["csv_ragged_report"] = o.sql(
    """SELECT 'succeeded' AS status, 'race_data_pit_stops' AS table_name, CAST(count_if(driverid % 7 = 0) AS BIGINT) AS rejected_rows,
  CAST(count_if(driverid % 7 = 0) AS BIGINT) AS rejected_cells, CAST(count_if(driverid % 11 = 0 OR driverid % 13 = 0) AS BIGINT) AS malformed_rows
FROM b_race_data_pit_stops""",
    "b_race_data_pit_stops",
)
ORACLE["layered_master"] = ORACLE["historical_master"]
ORACLE["csv_layered_master"] = ORACLE["historical_master"]
ORACLE["layered_views_incidents"] = ORACLE["historical_incidents"]
ORACLE["master_one_season"] = o.sql(
    """SELECT f.race_id, r.race_name, r.race_date, f.driver_id, f.team_id, f.position_order, f.points, f.year
FROM fact_results f JOIN dim_races r ON f.race_id = r.race_id WHERE f.year = 1997""",
    "fact_results", "dim_races",
)

_LI = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"
o.cte("li_existing", f"SELECT {_LI} FROM lineitem WHERE l_shipdate < DATE '1998-01-01'")
o.cte("li_incoming", f"SELECT {_LI} FROM lineitem WHERE l_shipdate >= DATE '1997-07-01'")
ORACLE["upsert_insert_only"] = o.sql(
    """SELECT * FROM li_existing
UNION ALL
SELECT * FROM li_incoming i WHERE NOT EXISTS (
  SELECT 1 FROM li_existing e WHERE e.l_orderkey = i.l_orderkey AND e.l_linenumber = i.l_linenumber)""",
    "li_existing", "li_incoming",
)
ORACLE["upsert_latest"] = o.sql(
    f"""SELECT {_LI} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM (SELECT * FROM li_existing UNION ALL SELECT * FROM li_incoming)) WHERE rn = 1""",
    "li_existing", "li_incoming",
)
ORACLE["partitioned_scan"] = (
    "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 1997"
)

# --- features, dashboard cuts, profiling ------------------------------------------------------

o.cte(
    "driver_seasons",
    "SELECT driver_id, year, count(*) AS races, sum(points) AS points, count_if(dnf_flag) AS dnfs "
    "FROM fact_results GROUP BY driver_id, year",
    "fact_results",
)
ORACLE["feat_trailing_avg"] = o.sql(
    """SELECT driver_id, year, races, points,
  sum(points) OVER w / sum(races) OVER w AS trailing_avg_points
FROM driver_seasons
WINDOW w AS (PARTITION BY driver_id ORDER BY year RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    "driver_seasons",
)
ORACLE["feat_dnf_rate"] = o.sql(
    "SELECT driver_id, count(*) AS results, avg(CAST(dnf_flag AS INTEGER)) AS dnf_rate FROM fact_results GROUP BY driver_id",
    "fact_results",
)
ORACLE["feat_pace_delta"] = o.sql(
    """SELECT q.driver_id, count(*) AS races, round(avg(q.q_pos - r.r_pos), 6) AS pace_delta
FROM (SELECT race_id, driver_id, avg(qualifying_position) AS q_pos FROM fact_qualifying GROUP BY ALL) q
JOIN (SELECT race_id, driver_id, avg(position_order) AS r_pos FROM fact_results GROUP BY ALL) r
  ON q.race_id = r.race_id AND q.driver_id = r.driver_id
GROUP BY q.driver_id""",
    "fact_qualifying", "fact_results",
)
ORACLE["feat_consistency"] = o.sql(
    "SELECT driver_id, count(*) AS results, round(var_pop(position_order), 6) AS position_variance "
    "FROM fact_results GROUP BY driver_id",
    "fact_results",
)
ORACLE["feat_team_momentum"] = o.sql(
    """SELECT t.team_id, t.race_id, r.race_date, t.team_points,
  avg(t.team_points) OVER (PARTITION BY t.team_id ORDER BY r.race_date, t.race_id
    ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS momentum
FROM (SELECT team_id, race_id, sum(points) AS team_points FROM fact_results GROUP BY ALL) t
JOIN dim_races r ON t.race_id = r.race_id""",
    "fact_results", "dim_races",
)
ORACLE["feat_session_weather"] = """SELECT t.session_date, t.telemetry_events, w.weather_readings, w.avg_weather
FROM (SELECT CAST(ts AS DATE) AS session_date, count(*) AS telemetry_events FROM events
      WHERE event_type IS DISTINCT FROM 'purchase' GROUP BY 1) t
LEFT JOIN (SELECT CAST(ts AS DATE) AS session_date, count(*) AS weather_readings, round(avg(value), 6) AS avg_weather
      FROM events WHERE event_type IN ('purchase') GROUP BY 1) w ON t.session_date = w.session_date"""

ORACLE["trend_championship"] = o.sql(
    """SELECT "Season" AS season, "Team ID" AS team_id, count(DISTINCT "Race Key") AS races, sum("Points") AS points,
  count(*) FILTER (WHERE "Finish Position" = 1) AS wins, count(*) FILTER (WHERE "DNF") AS dnfs
FROM historical_master GROUP BY 1, 2""",
    "historical_master",
)
ORACLE["trend_circuits"] = o.sql(
    """SELECT "Country" AS country, count(DISTINCT "Race Key") AS races, count(*) AS results,
  avg("Grid Position") AS avg_grid, avg("Points") AS avg_points
FROM historical_master GROUP BY 1""",
    "historical_master",
)
ORACLE["trend_pit_impact"] = o.sql(
    """SELECT "Pit Stops" AS pit_stops, count(*) AS results, avg("Positions Gained") AS avg_positions_gained,
  avg("Position Order") AS avg_position_order, avg(CAST("DNF" AS INTEGER)) AS dnf_rate
FROM historical_master GROUP BY 1""",
    "historical_master",
)
ORACLE["trend_driver_team"] = o.sql(
    """SELECT "Driver ID" AS driver_id, "Team Nationality" AS team_nationality, count(*) AS starts,
  sum("Points") AS points, min("Finish Position") AS best_finish, avg("Finish Position") AS avg_finish
FROM historical_master GROUP BY 1, 2""",
    "historical_master",
)

_FR_TYPES = [
    ("race_key", "string"), ("year", "int"), ("driver_full_name", "string"), ("driver_id", "bigint"),
    ("team_name", "string"), ("team_id", "bigint"), ("car_number", "int"), ("grid_position", "int"),
    ("finish_position", "int"), ("position_order", "int"), ("points", "double"), ("laps", "int"),
    ("race_time_ms", "int"), ("fastest_lap_number", "int"), ("fastest_lap_rank", "int"),
    ("fastest_lap_speed", "double"), ("status", "string"), ("dnf_flag", "boolean"),
    ("positions_gained", "int"), ("pit_stop_count", "bigint"), ("total_pit_time_ms", "bigint"), ("race_id", "bigint"),
]
ORACLE["profile_fact_results"] = o.sql(
    "\nUNION ALL\n".join(
        f"SELECT 'fact_results' AS table_name, {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"count(*) AS row_count, count_if({c} IS NULL) AS null_count, "
        f"{f'count(DISTINCT {c})' if c in ('driver_id', 'team_id', 'race_id', 'year', 'status') else 'CAST(NULL AS BIGINT)'} AS distinct_count FROM fact_results"
        for i, (c, t) in enumerate(_FR_TYPES)
    ),
    "fact_results",
)
ORACLE["profile_distinct_sorted"] = o.sql(
    "SELECT DISTINCT positiontext FROM s_race_data_results", "s_race_data_results"
)
ORACLE["profile_head"] = o.sql("SELECT * FROM dim_races ORDER BY race_id LIMIT 5", "dim_races")
ORACLE["profile_layer"] = o.sql(
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, "
        f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM s_{t})) AS column_count FROM s_{t}"
        for t in SOURCE_TABLES
    ),
    *[f"s_{t}" for t in SOURCE_TABLES],
)

# --- streaming --------------------------------------------------------------------------------

ORACLE["stream_hourly"] = """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS events, round(sum(value), 2) AS value_sum
FROM events GROUP BY 1, 2, 3"""
ORACLE["stream_dedupe_upsert"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
ORACLE["stream_two_feeds"] = """WITH w AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket_start, count(*) AS weather_readings,
    round(avg(value), 6) AS weather_avg
  FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT e.event_id, e.ts, e.event_type, e.value, time_bucket(INTERVAL 15 MINUTE, e.ts) AS bucket_start,
  w.weather_readings, w.weather_avg
FROM events e LEFT JOIN w ON time_bucket(INTERVAL 15 MINUTE, e.ts) = w.bucket_start
WHERE e.event_type IS DISTINCT FROM 'purchase'"""


def _gold_dq() -> tuple[str, list[str]]:
    parts, deps = [], []
    for m in sorted({e.table for e in _c.GOLD}):
        for chk in [e for e in _c.GOLD if e.table == m]:
            cols = ", ".join(chk.column.split(","))
            parts.append(
                f"SELECT {_dlit(m)} AS table_name, {_dlit(_c.NAMES[chk.kind])} AS check_name, "
                f"{_dlit(chk.column)} AS column_name, count(*) - count(DISTINCT ({cols})) AS unexpected_count, "
                f"count(*) - count(DISTINCT ({cols})) = 0 AS success, {_dlit(_c.rule(chk))} AS rule, CAST(NULL AS VARCHAR) AS first_example FROM {m}"
            )
            deps.append(m)
    return "\nUNION ALL\n".join(parts), deps


_gold_body, _gold_deps = _gold_dq()
ORACLE["dq_gold_report"] = o.sql(_gold_body, *_gold_deps)

# --- model -----------------------------------------------------------------------------------

_SEASON_FEATURES = """WITH per AS (
  SELECT driver_id, year, count(*) AS n, sum(points) AS points, sum(CAST(dnf_flag AS INTEGER)) AS dnfs,
    count(position_order) AS k, sum(position_order) AS s1, sum(CAST(position_order AS DOUBLE) * position_order) AS s2
  FROM fact_results GROUP BY 1, 2
), q AS (SELECT race_id, driver_id, year, avg(qualifying_position) AS q_pos FROM fact_qualifying GROUP BY 1, 2, 3),
r AS (SELECT race_id, driver_id, avg(position_order) AS r_pos FROM fact_results GROUP BY 1, 2),
pace AS (SELECT driver_id, year, sum(q_pos - r_pos) AS pace, count(q_pos - r_pos) AS paced
  FROM q JOIN r USING (race_id, driver_id) GROUP BY 1, 2),
sums AS (
  SELECT driver_id, year, points AS label, sum(n) OVER w AS n, sum(points) OVER w AS p, sum(dnfs) OVER w AS d,
    sum(k) OVER w AS k, sum(s1) OVER w AS s1, sum(s2) OVER w AS s2, sum(pace) OVER w AS pace, sum(paced) OVER w AS paced
  FROM per LEFT JOIN pace USING (driver_id, year)
  WINDOW w AS (PARTITION BY driver_id ORDER BY year RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)
), feats AS (
  SELECT driver_id, year, label, round(coalesce(p / nullif(n, 0), 0.0), 6) AS prev_avg_points,
    round(coalesce(CAST(d AS DOUBLE) / nullif(n, 0), 0.0), 6) AS dnf_rate,
    round(coalesce(pace / nullif(paced, 0), 0.0), 6) AS pace_delta,
    round(coalesce(s2 / nullif(k, 0), 0.0) - coalesce(CAST(s1 AS DOUBLE) / nullif(k, 0), 0.0) * coalesce(CAST(s1 AS DOUBLE) / nullif(k, 0), 0.0), 4) AS position_variance,
    CAST(coalesce(n, 0) AS BIGINT) AS prev_races FROM sums
)"""


def _with(ctes: str, body: str) -> str:
    """The shared fact tables and then the local steps, in one WITH."""
    inner = o.sql("SELECT 1", "fact_results", "fact_qualifying").rsplit("SELECT 1", 1)[0].rstrip()
    return f"{inner},\n{ctes.removeprefix('WITH ')}\n{body}"


ORACLE["model_season_features"] = _with(_SEASON_FEATURES, "SELECT * FROM feats")
ORACLE["model_actual_ranks"] = _with(
    _SEASON_FEATURES,
    """SELECT driver_id, year AS season, round(label, 4) AS actual_points,
  CAST(rank() OVER (PARTITION BY year ORDER BY round(label, 4) DESC) AS INTEGER) AS actual_rank FROM feats""",
)
ORACLE["model_prediction_properties"] = _with(
    _SEASON_FEATURES,
    """SELECT count(*) AS drivers, count(DISTINCT driver_id) AS distinct_drivers, CAST(1 AS BIGINT) AS first_rank,
  round(sum(label), 4) AS actual_points, true AS differences_hold, true AS all_predicted FROM feats WHERE year = 2001""",
)
ORACLE["stream_batch_quality"] = """SELECT * FROM (
  SELECT 'expect_not_null' AS check_name, 'event_id' AS column_name, 'event_id IS NOT NULL' AS rule,
    count_if(event_id IS NULL) AS unexpected_count, count_if(event_id IS NULL) = 0 AS success, CAST(NULL AS VARCHAR) AS first_example FROM events
  UNION ALL SELECT 'expect_not_null', 'ts', 'ts IS NOT NULL', count_if(ts IS NULL), count_if(ts IS NULL) = 0, NULL FROM events
  UNION ALL SELECT 'expect_not_null', 'value', 'value IS NOT NULL', count_if(value IS NULL), count_if(value IS NULL) = 0, NULL FROM events
  UNION ALL SELECT 'expect_between', 'value', 'value BETWEEN 0 AND 40', count_if(NOT value BETWEEN 0 AND 40),
    count_if(NOT value BETWEEN 0 AND 40) = 0, min(CASE WHEN NOT value BETWEEN 0 AND 40 THEN CAST(value AS VARCHAR) END) FROM events
  UNION ALL SELECT 'expect_match_regex', 'event_type', 'event_type RLIKE ^[a-z]+$', count_if(NOT regexp_matches(event_type, '^[a-z]+$')),
    count_if(NOT regexp_matches(event_type, '^[a-z]+$')) = 0, NULL FROM events)"""

_MARRED = """WITH marred AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts, user_id,
    CASE WHEN event_id % 53 = 0 THEN upper(event_type) ELSE event_type END AS event_type, CASE WHEN event_id % 89 <> 0 THEN value END AS value, props FROM events
), judged AS (
  SELECT *, concat_ws('; ', CASE WHEN event_id IS NULL THEN 'event_id IS NOT NULL' END, CASE WHEN ts IS NULL THEN 'ts IS NOT NULL' END,
    CASE WHEN value IS NULL THEN 'value IS NOT NULL' END, CASE WHEN NOT value BETWEEN 0 AND 40 THEN 'value BETWEEN 0 AND 40' END,
    CASE WHEN NOT regexp_matches(event_type, '^[a-z]+$') THEN 'event_type RLIKE ^[a-z]+$' END) AS reasons FROM marred
)
"""
ORACLE["stream_good_events"] = _MARRED + "SELECT event_id, ts, user_id, event_type, value, props FROM judged WHERE reasons = ''"
ORACLE["stream_quarantine"] = _MARRED + "SELECT * FROM judged WHERE reasons <> ''"
ORACLE["stream_latency"] = "SELECT CAST(8 AS BIGINT) AS batches, 2 * count(*) AS rows, CAST(0 AS BIGINT) AS first_batch, true AS measured FROM events"
ORACLE["stream_live_feeds"] = """WITH w AS (SELECT ts AS reading_ts, value AS reading FROM events WHERE event_type = 'purchase'),
e AS (SELECT * FROM events WHERE event_type IS DISTINCT FROM 'purchase')
SELECT event_id, ts, event_type, value,
  CASE WHEN ts < reading_ts + INTERVAL 10 MINUTE THEN reading_ts END AS reading_ts,
  CASE WHEN ts < reading_ts + INTERVAL 10 MINUTE THEN reading END AS reading
FROM e ASOF LEFT JOIN w ON e.ts >= w.reading_ts"""
ORACLE["upsert_merge_files"] = ORACLE["upsert_latest"]
ORACLE["upsert_null_keys"] = o.sql(
    """, a AS (SELECT * REPLACE (CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS l_orderkey) FROM li_existing),
b AS (SELECT * REPLACE (CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS l_orderkey) FROM li_incoming)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.l_orderkey IS NOT DISTINCT FROM b.l_orderkey
  AND a.l_linenumber = b.l_linenumber AND a.l_suppkey = b.l_suppkey)""",
    "li_existing", "li_incoming",
)

_SESSION_LENGTHS = {"race": 120, "fp1": 60, "fp2": 60, "fp3": 60, "quali": 60, "sprint": 60}
_SESSIONS = "sess AS (" + " UNION ALL ".join(
    f"SELECT raceid, '{k}' AS session, {_ts('date' if k == 'race' else k + '_date', 'time' if k == 'race' else k + '_time')} AS t, {m} AS minutes FROM s_race_data_races"
    for k, m in _SESSION_LENGTHS.items()
) + """), moved AS (
  SELECT raceid, session, TIMESTAMP '2024-01-01' + to_days(CAST((date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) % 30 + 30) % 30 AS INTEGER)) + (t - date_trunc('day', t)) AS starts, minutes
  FROM sess WHERE t IS NOT NULL
), sessions AS (SELECT raceid, session, starts, starts + to_minutes(minutes) AS ends FROM moved),
readings AS (SELECT ts, value FROM events WHERE event_type = 'purchase'),
spans AS (SELECT DISTINCT starts, ends FROM sessions),
inside AS (SELECT starts, ends, count(*) AS n, round(avg(value), 6) AS mean FROM spans JOIN readings ON ts >= starts AND ts < ends GROUP BY 1, 2),
in_sessions AS (SELECT sessions.*, coalesce(n, 0) AS weather_readings, mean AS avg_weather FROM sessions LEFT JOIN inside USING (starts, ends))"""


def _after(deps: list[str], *steps: str) -> str:
    """Shared tables, further steps and a query in one WITH."""
    inner = o.sql("SELECT 1", *deps).rsplit("SELECT 1", 1)[0].rstrip()
    return f"{inner},\n" + ",\n".join(s.removeprefix("WITH ") for s in steps[:-1]) + f"\n{steps[-1]}"


ORACLE["feat_weather_in_sessions"] = _after(["s_race_data_races"], _SESSIONS, "SELECT * FROM in_sessions WHERE starts >= DATE '2024-01-10'")
_FORM = """per_race AS (
  SELECT t.team_id, t.race_id, avg(t.points) OVER (PARTITION BY t.team_id ORDER BY r.race_date, t.race_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS momentum
  FROM (SELECT team_id, race_id, sum(points) AS points FROM fact_results GROUP BY ALL) t JOIN dim_races r ON t.race_id = r.race_id
), form AS (
  SELECT driver_id, f.year, sum(momentum) AS m, count(momentum) AS mk, sum(avg_weather) AS w, count(avg_weather) AS wk
  FROM fact_results f LEFT JOIN per_race p ON p.team_id = f.team_id AND p.race_id = f.race_id
  LEFT JOIN (SELECT raceid, avg_weather FROM in_sessions WHERE session = 'race') i ON i.raceid = f.race_id GROUP BY 1, 2
), means AS (
  SELECT driver_id, year, round(coalesce(sum(m) OVER w3 / nullif(sum(mk) OVER w3, 0), 0.0), 4) AS team_momentum,
    round(coalesce(sum(w) OVER w3 / nullif(sum(wk) OVER w3, 0), 0.0), 4) AS weather
  FROM form WINDOW w3 AS (PARTITION BY driver_id ORDER BY year RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)
)"""
ORACLE["model_full_features"] = _after(
    ["fact_results", "fact_qualifying", "dim_races", "s_race_data_races"], _SEASON_FEATURES, _SESSIONS, _FORM,
    "SELECT feats.*, coalesce(team_momentum, 0.0) AS team_momentum, coalesce(weather, 0.0) AS weather FROM feats LEFT JOIN means USING (driver_id, year)",
)
ORACLE["model_plain_errors"] = _with(
    _SEASON_FEATURES,
    """SELECT a.year AS season, count(*) AS drivers, round(any_value(m), 4) AS plain_mean, round(avg(abs(label - m)), 4) AS plain_mae,
  round(sqrt(avg((label - m) * (label - m))), 4) AS plain_rmse
FROM feats a JOIN (SELECT s.year, avg(b.label) AS m FROM (SELECT DISTINCT year FROM feats) s JOIN feats b ON b.year < s.year GROUP BY 1) p ON p.year = a.year
WHERE a.year >= 1996 GROUP BY 1""",
)

ORACLE["dq_incremental_races"] = o.sql(f"SELECT * FROM ({_silver_body}) WHERE table_name = 'race_data_races'", *_silver_deps)

o.cte(
    "dim_sessions",
    " UNION ALL ".join(
        f"SELECT raceid AS race_id, '{k}' AS session, t AS starts, t + to_minutes({m}) AS ends FROM (SELECT raceid, {_ts('date' if k == 'race' else k + '_date', 'time' if k == 'race' else k + '_time')} AS t FROM s_race_data_races) WHERE t IS NOT NULL"
        for k, m in _SESSION_LENGTHS.items()
    ),
    "s_race_data_races",
)
for _m in GOLD_MODELS:
    ORACLE[_m] = o.select_all(_m)
