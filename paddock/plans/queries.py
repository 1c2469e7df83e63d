"""Registered queries over the provided tables: (spark, sf_dir) -> DataFrame.

Every query reads the provided tables (through the bridge) so its work
grows with them; none runs on literal input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import text, timefmt
from ..operators import clean, features, model, profile, quality
from ..session import cut_lineage, dropped_shuffles, scratch_path
from ..sources import catalog, ingest, upsert
from ..sources.registry import SOURCE_TABLES, BridgeSources
from ..sources.schemas import BRONZE_SCHEMAS
from ..streaming import telemetry
from . import trends, views
from .gold import GOLD_MODELS, GoldModels

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def gold_models(spark: SparkSession, sf_dir: str) -> GoldModels:
    return GoldModels(BridgeSources(spark, sf_dir))


def _gold_query(model: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold_models(spark, sf_dir).ref(model)

    q.__name__ = f"gold_{model}"
    return q


for _m in GOLD_MODELS:
    REGISTRY[_m] = _gold_query(_m)


@register("historical_master")
def historical_master(spark, sf_dir):
    return views.historical_master(gold_models(spark, sf_dir))


@register("historical_overview")
def historical_overview(spark, sf_dir):
    return views.historical_overview(views.historical_master(gold_models(spark, sf_dir)))


@register("historical_drivers_teams")
def historical_drivers_teams(spark, sf_dir):
    return views.historical_drivers_teams(views.historical_master(gold_models(spark, sf_dir)))


@register("historical_seasons")
def historical_seasons(spark, sf_dir):
    return views.historical_seasons(views.historical_master(gold_models(spark, sf_dir)))


@register("historical_incidents")
def historical_incidents(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return views.historical_incidents(g.ref("event_race_incidents"), g.ref("event_fatal_accidents"))


# --- Silver: full cleaning chain per table (P8, P9 and everything under it) ---

def _silver_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return BridgeSources(spark, sf_dir).silver(table)

    q.__name__ = f"silver_{table}"
    return q


for _t in SOURCE_TABLES:
    REGISTRY[f"silver_{_t}"] = _silver_query(_t)


# --- single cleaning rules on one Bronze table ---------------------------------

@register("rule_trim_strings")
def rule_trim_strings(spark, sf_dir):
    """P3 alone: blank trimming of every string column (circuits)."""
    return clean.trim_strings(BridgeSources(spark, sf_dir).bronze("race_data_circuits"))


@register("rule_value_map")
def rule_value_map(spark, sf_dir):
    """Trim then the race-data value map (results)."""
    b = BridgeSources(spark, sf_dir).bronze("race_data_results")
    return clean.map_string_values(clean.trim_strings(b), "race_data_results")


@register("rule_event_map")
def rule_event_map(spark, sf_dir):
    """P5: trim then the race-events value map (red flags)."""
    b = BridgeSources(spark, sf_dir).bronze("race_events_red_flags")
    return clean.map_string_values(clean.trim_strings(b), "race_events_red_flags")


@register("rule_multi_format_date")
def rule_multi_format_date(spark, sf_dir):
    """Multi-layout date parse with the century pivot, raw text kept."""
    b = BridgeSources(spark, sf_dir).bronze("race_events_fatal_accidents_drivers")
    return b.select(
        F.col("date_of_accident").alias("date_text"),
        timefmt.parse_multi_format_date("date_of_accident").alias("date_of_accident"),
    )


@register("rule_safe_int_cast")
def rule_safe_int_cast(spark, sf_dir):
    """try_cast of the integer-named columns after trim and map."""
    b = BridgeSources(spark, sf_dir).bronze("race_data_results")
    m = clean.map_string_values(clean.trim_strings(b), "race_data_results")
    return clean.cast_int_columns(m).select("resultid", *clean.INT_CAST_COLUMNS)


@register("rule_time_to_ms")
def rule_time_to_ms(spark, sf_dir):
    """duration text in four layouts to milliseconds."""
    b = BridgeSources(spark, sf_dir).bronze("race_data_qualifying")
    return b.select(
        "raceid", "driverid", "q1", "q2",
        timefmt.time_to_ms("q1").alias("q1_ms"),
        timefmt.time_to_ms("q2").alias("q2_ms"),
    )


@register("rule_wall_clock")
def rule_wall_clock(spark, sf_dir):
    """keep H:MM:SS of the pit-stop clock text."""
    b = BridgeSources(spark, sf_dir).bronze("race_data_pit_stops")
    return b.select("raceid", "driverid", "stop", F.col("time").alias("time_text"),
                    timefmt.clean_wall_clock("time").alias("wall_clock"))


@register("rule_cause_normalise")
def rule_cause_normalise(spark, sf_dir):
    """Ordered case-insensitive cause rewrite (safety cars)."""
    b = BridgeSources(spark, sf_dir).bronze("race_events_safety_cars")
    return b.select(F.col("cause").alias("cause_text"), text.normalise_cause("cause").alias("cause"))


@register("session_timestamps")
def session_timestamps(spark, sf_dir):
    """race and session timestamps from Silver date + wall-clock pairs."""
    s = BridgeSources(spark, sf_dir).silver("race_data_races")
    sessions = [("race", "date", "time")] + [(p, f"{p}_date", f"{p}_time") for p in ("fp1", "fp2", "fp3", "quali", "sprint")]
    return s.select("raceid", *[timefmt.session_timestamp(d, t).alias(f"{p}_timestamp") for p, d, t in sessions])


# --- quality suites ------------------------------------------------------------

@register("dq_silver_report")
def dq_silver_report(spark, sf_dir):
    src = BridgeSources(spark, sf_dir)
    return quality.check_tables(src.silver, SOURCE_TABLES)


@register("dq_bronze_report")
def dq_bronze_report(spark, sf_dir):
    src = BridgeSources(spark, sf_dir)
    return quality.check_tables(src.bronze, SOURCE_TABLES)


@register("dq_incremental_races")
def dq_incremental_races(spark, sf_dir):
    """V13 by season: the suite of the races season by season, the last one
    checked alone and later, then once more; the states together are the
    report of the whole table."""
    from ..sources.versions import VersionedTable

    races = BridgeSources(spark, sf_dir).silver("race_data_races")
    season = F.year("date").cast("string")
    seasons = sorted((r[0] for r in races.select(season).distinct().collect()), key=lambda s: (s is not None, s or ""))  # a row a season
    store = VersionedTable(spark, scratch_path(spark, "check-states"))
    for some in (seasons[:-1], seasons[-1:], seasons[-1:]):
        report = catalog.check_parts(store, races, "race_data_races", season, some)
    return report


@register("dq_table_verdicts")
def dq_table_verdicts(spark, sf_dir):
    src = BridgeSources(spark, sf_dir)
    return quality.table_verdicts(quality.check_tables(src.bronze, SOURCE_TABLES))


@register("dq_gold_report")
def dq_gold_report(spark, sf_dir):
    """V-suites on Gold: the join keys of the star schema are unique."""
    g = gold_models(spark, sf_dir)
    from functools import reduce

    parts = [quality.check_table(g.ref(m), m, checks) for m, checks in sorted(quality.GOLD_SUITES.items())]
    return reduce(DataFrame.unionByName, parts)


@register("dq_failure_examples")
def dq_failure_examples(spark, sf_dir):
    """Up to five smallest offending values per failed Bronze value check."""
    src = BridgeSources(spark, sf_dir)
    report = quality.check_tables(src.bronze, SOURCE_TABLES)
    failed = report.where("NOT success AND unexpected_count IS NOT NULL").select(
        "table_name", "check_name", "column_name"
    ).collect()  # at most one row per check
    by_table: dict[str, list[tuple[str, str]]] = {}
    for r in failed:
        by_table.setdefault(r.table_name, []).append((r.check_name, r.column_name))
    parts = [quality.failure_examples(src.bronze(t), t, keys) for t, keys in sorted(by_table.items())]
    if not parts:  # nothing failed: an empty result with the same columns
        return quality.failure_examples(src.bronze(SOURCE_TABLES[0]), SOURCE_TABLES[0], [])
    from functools import reduce
    return reduce(DataFrame.unionByName, parts)


# --- ingest, layers, upserts, partitioned writes -------------------------------------


# Awkward CSV headers for the circuits round trip.
AWKWARD_CIRCUIT_HEADERS = (
    ("circuitid", "Circuit Id", LongType()),
    ("circuitref", "circuitRef", StringType()),
    ("name", "Name", StringType()),
    ("location", "Location(City)", StringType()),
    ("country", "Country", StringType()),
    ("lat", "Lat", DoubleType()),
    ("lng", "Lng", DoubleType()),
    ("alt", "Alt=Meters", IntegerType()),
    ("url", "URL", StringType()),
)


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Bronze circuits written as CSV under awkward headers, read
    back with a declared schema, names sanitised (run stamp dropped)."""
    src = BridgeSources(spark, sf_dir).bronze("race_data_circuits")
    out = src.toDF(*[h for _, h, _ in AWKWARD_CIRCUIT_HEADERS])
    folder = scratch_path(spark, "csv-roundtrip")
    ingest.write_csv(out, f"{folder}/circuits.csv")
    schema = StructType([StructField(h, t) for _, h, t in AWKWARD_CIRCUIT_HEADERS])
    return ingest.sanitize_columns(ingest.read_csv(spark, f"{folder}/circuits.csv", schema).drop(ingest.REJECTED))


@register("sanitize_columns")
def sanitize_columns(spark, sf_dir):
    """P1 on awkward names over the lineitem table."""
    from ..sources.bridge import read_table

    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ingest.sanitize_columns(li.toDF("L Order(Key)", "l;Line Number", "L=Quantity"))


def _run_ingest(spark, sf_dir):
    """Land orders, nation and region as CSV, pre-create the nation table,
    ingest all three (region against a wrong declared schema)."""
    from ..sources.bridge import read_table

    root = scratch_path(spark, "ingest")
    landing = f"{root}/landing"
    for t in ("orders", "nation", "region"):
        ingest.write_csv(read_table(spark, sf_dir, t), f"{landing}/{t}.csv")
    schema_name = "landing_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, [schema_name], root)
    read_table(spark, sf_dir, "nation").write.saveAsTable(f"{schema_name}.landing_nation")
    files, errors = ingest.list_csv_files(spark, [landing, f"{root}/missing"])
    bad_region = StructType([StructField("r_regionkey", IntegerType()), StructField("r_name", IntegerType())])
    report = ingest.ingest_files(
        spark, files, schema_name, schemas={"landing_region": bad_region}, mode="FAILFAST", unlisted=errors
    )
    return report, schema_name


@register("ingest_report")
def ingest_report(spark, sf_dir):
    """Three landing files ingested concurrently:
    one new, one whose table exists (skipped), one that fails its declared
    schema, and a folder that can't be listed; report plus row counts of what
    landed."""
    report, schema_name = _run_ingest(spark, sf_dir)
    counts = {
        r.table_name: spark.table(f"{schema_name}.{r.table_name}").count()
        for r in report.where("status = 'succeeded'").collect()
    }
    count_col = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v))]) if counts else None
    out = report.select(
        "status", F.element_at(F.split("file_name", "/"), -1).alias("file_name"), "table_name",
        F.col("message").isNotNull().alias("has_message"),
        (count_col[F.col("table_name")] if count_col is not None else F.lit(None)).cast("bigint").alias("row_count"),
    )
    return out


@register("ingest_summary")
def ingest_summary(spark, sf_dir):
    """The run summary, files and rejected rows and cells per status."""
    report, _ = _run_ingest(spark, sf_dir)
    return ingest.report_summary(report)


def _land_csv(spark, sf_dir, root, tables=SOURCE_TABLES):
    """The Bronze tables as CSV under their source files' headers; columns
    that the provided data lack are empty."""
    src = BridgeSources(spark, sf_dir)

    def land(t: str) -> None:
        df = src.bronze(t)
        cells = []
        for f in BRONZE_SCHEMAS[t].fields:
            name = ingest.sanitize_name(f.name)
            cells.append((F.col(name) if name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name))
        folder = "race_events" if t.startswith("race_events") else "race_data"
        ingest.write_csv(df.select(*cells), f"{root}/{folder}/{t.removeprefix(folder + '_')}.csv", compression="gzip")

    with dropped_shuffles(spark):
        for t in tables:
            land(t)
    return ingest.list_csv_files(spark, [f"{root}/race_data", f"{root}/race_events"])


@register("csv_layered_master")
def csv_layered_master(spark, sf_dir):
    """S1-S14 end to end: 18 CSV files by header name -> Bronze -> Silver ->
    gate -> Gold -> gate -> the master view by name."""
    names = _layers(spark, "csv-layers")
    files, errors = _land_csv(spark, sf_dir, f"{_layer_root(names)}/landing")
    report = ingest.ingest_files(spark, files, names["bronze"], unlisted=errors)
    failed = report.where("status <> 'succeeded'").collect()  # a row a file
    if failed:
        raise RuntimeError(f"not ingested: {failed}")
    _build_layers(spark, names)
    return spark.table(f"{names['dashboard']}.historical_master")


@register("csv_rejects")
def csv_rejects(spark, sf_dir):
    """Cells that don't cast are NULL and counted; columns are found by
    name in a header of another order; a header without a declared column
    fails its file."""
    src = BridgeSources(spark, sf_dir)
    root = scratch_path(spark, "rejects")
    stops = src.bronze("race_data_pit_stops")
    odd = F.when(F.col("driverid") % 7 == 0, F.lit("one")).otherwise(F.col("stop").cast("string"))
    header = ["milliseconds", "raceId", "duration", "driverId", "time", "lap", "stop"]
    ingest.write_csv(stops.withColumn("stop", odd).select(*[F.col(h.lower()).alias(h) for h in header]), f"{root}/race_data/pit_stops.csv")
    ingest.write_csv(src.bronze("race_data_status").select(F.col("status")), f"{root}/race_data/status.csv")
    schema_name = "rejects_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, [schema_name], root)
    files, errors = ingest.list_csv_files(spark, [f"{root}/race_data"])
    report = ingest.ingest_files(spark, files, schema_name, unlisted=errors)
    landed = spark.table(f"{schema_name}.race_data_pit_stops").agg(
        F.count("stop").alias("n_stops"), F.sum("lap").alias("sum_laps"), F.sum("driverid").alias("sum_drivers")
    )
    keep = report.select("status", "table_name", "rejected_rows", "rejected_cells", "error")
    return keep.join(landed.withColumn("t", F.lit("race_data_pit_stops")), F.col("table_name") == F.col("t"), "left").drop("t")


def _land_lines(lines, header, path):
    """Rows of text as CSV files, each with the header first."""
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # within its partition
    first = F.when(nth == 0, F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
    lines.select("line").withColumn("lines", first).select(F.explode("lines").alias("line")).write.text(path)


def _ragged(spark, sf_dir):
    """Pit stops as text with faults: a cell too many, one too few, a quoted
    time over two lines, a stop that is no number."""
    b = BridgeSources(spark, sf_dir).bronze("race_data_pit_stops")
    d = F.col("driverid")
    cell = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("raceid", "driverid", "stop", "lap", "time", "duration", "milliseconds")}
    cell["time"] = F.when(d % 17 == 0, F.concat(F.lit('"at\n'), cell["time"], F.lit('"'))).otherwise(cell["time"])
    cell["stop"] = F.when(d % 7 == 0, F.lit("one")).otherwise(cell["stop"])
    line = F.concat_ws(",", *cell.values())
    short = F.concat_ws(",", *(c for n, c in cell.items() if n != "milliseconds"))
    line = F.when(d % 11 == 0, F.concat(line, F.lit(",EXTRA, CELLS"))).when(d % 13 == 0, short).otherwise(line)
    root = scratch_path(spark, "ragged")
    _land_lines(b.select(line.alias("line")), "raceId,driverId,stop,lap,time,duration,milliseconds", f"{root}/race_data/pit_stops.csv")
    schema_name = "ragged_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, [schema_name], root)
    files, errors = ingest.list_csv_files(spark, [f"{root}/race_data"])
    return ingest.ingest_files(spark, files, schema_name, unlisted=errors), schema_name


@register("csv_quarantine")
def csv_quarantine(spark, sf_dir):
    """Every record with extra, missing or bad cells, whole, with its reason."""
    _, schema_name = _ragged(spark, sf_dir)
    return spark.table(f"{schema_name}.race_data_pit_stops{ingest.QUARANTINE}").drop("ingested_at")


@register("csv_ragged_rows")
def csv_ragged_rows(spark, sf_dir):
    """What the table holds of such a file: a row for each record, cells
    over two lines whole, cells that are missing or don't cast NULL."""
    _, schema_name = _ragged(spark, sf_dir)
    return spark.table(f"{schema_name}.race_data_pit_stops").drop("ingested_at")


@register("csv_ragged_report")
def csv_ragged_report(spark, sf_dir):
    """Such a file is reported with its malformed rows and rejected cells."""
    report, _ = _ragged(spark, sf_dir)
    return report.select("status", "table_name", "rejected_rows", "rejected_cells", "malformed_rows")


_LAYER_ROOTS: dict[str, str] = {}


def _layers(spark, name):
    root = scratch_path(spark, name)
    suffix = root.rsplit("-", 1)[-1]
    names = {layer: f"{layer}_{suffix}" for layer in catalog.LAYERS}
    catalog.create_layers(spark, names.values(), root)
    _LAYER_ROOTS[names["bronze"]] = root
    return names


def _layer_root(names):
    return _LAYER_ROOTS[names["bronze"]]


@register("layered_master")
def layered_master(spark, sf_dir):
    """The full layer build through the catalog:
    Bronze tables -> Silver (stamped) -> quality gate -> Gold tables ->
    dashboard view read back by name."""
    names = _layers(spark, "layers")
    src = BridgeSources(spark, sf_dir)
    catalog.write_layer({t: catalog.stamp(src.bronze(t), "ingested_at") for t in SOURCE_TABLES}, names["bronze"])
    catalog.reset_layer(spark, names["silver"], _layer_root(names))  # S10: rebuild Silver from scratch
    _build_layers(spark, names)
    return spark.table(f"{names['dashboard']}.historical_master")


def _build_layers(spark, names):
    tables = catalog.build_silver(spark, names["bronze"], names["silver"])
    catalog.silver_gate(spark, names["silver"], tables)
    catalog.build_gold(spark, names["silver"], names["gold"])
    catalog.gold_gate(spark, names["gold"])
    catalog.create_dashboard_views(spark, names["gold"], names["dashboard"])


@register("master_one_season")
def master_one_season(spark, sf_dir):
    """M2 in the layers: one season of the written fact, whose folders of
    other seasons aren't read, with its races."""
    names = _layers(spark, "season")
    src = BridgeSources(spark, sf_dir)
    tables = ("race_data_races", "race_data_results", "race_data_drivers", "race_data_constructors", "race_data_status", "race_data_pit_stops")
    catalog.write_layer({t: catalog.stamp(src.bronze(t), "ingested_at") for t in tables}, names["bronze"])
    catalog.build_silver(spark, names["bronze"], names["silver"], tables)
    catalog.build_gold(spark, names["silver"], names["gold"], ("dim_races", "fact_results"))
    fact = spark.table(f"{names['gold']}.fact_results").where(F.col("year") == 1997)
    races = spark.table(f"{names['gold']}.dim_races").select("race_id", "race_name", "race_date")
    return fact.join(races, "race_id").select("race_id", "race_name", "race_date", "driver_id", "team_id", "position_order", "points", "year")


@register("layered_views_incidents")
def layered_views_incidents(spark, sf_dir):
    """The incidents view read by name from the dashboard schema."""
    names = _layers(spark, "incidents")
    src = BridgeSources(spark, sf_dir)
    catalog.write_layer({t: catalog.stamp(src.bronze(t), "ingested_at") for t in SOURCE_TABLES}, names["bronze"])
    _build_layers(spark, names)
    return spark.table(f"{names['dashboard']}.historical_incidents")


_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def _lineitem_split(spark, sf_dir):
    from ..sources.bridge import read_table

    li = read_table(spark, sf_dir, "lineitem").select(*_LI_COLS)
    return li.where("l_shipdate < DATE'1998-01-01'"), li.where("l_shipdate >= DATE'1997-07-01'")


@register("upsert_insert_only")
def upsert_insert_only(spark, sf_dir):
    """M1 insert-only: existing rows, then incoming rows with new
    (l_orderkey, l_linenumber) keys appended; a rerun appends nothing."""
    names = _layers(spark, "upsert")
    table = f"{names['bronze']}.lineitem"
    existing, incoming = _lineitem_split(spark, sf_dir)
    existing.write.saveAsTable(table)
    upsert.upsert_insert_only(spark, table, incoming, ["l_orderkey", "l_linenumber"])
    assert upsert.upsert_insert_only(spark, table, incoming, ["l_orderkey", "l_linenumber"]) == 0
    return spark.table(table)


@register("upsert_latest")
def upsert_latest(spark, sf_dir):
    """M1 latest-wins + N5: one row per (l_orderkey, l_linenumber), the one
    with the latest ship date (ties broken on the other columns)."""
    names = _layers(spark, "latest")
    table = f"{names['bronze']}.lineitem"
    existing, incoming = _lineitem_split(spark, sf_dir)
    existing.write.saveAsTable(table)
    upsert.upsert_latest(spark, table, incoming, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return spark.table(table)


@register("upsert_merge_files")
def upsert_merge_files(spark, sf_dir):
    """M1 latest-wins on a versioned table: only files that hold an incoming
    key are rewritten. Two merges: old and new rows, then the newest again,
    which changes nothing."""
    from ..sources.versions import VersionedTable, merge_latest

    table = VersionedTable(spark, scratch_path(spark, "merge"))
    existing, incoming = _lineitem_split(spark, sf_dir)
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    merge_latest(table, existing, keys, order)
    merge_latest(table, incoming, keys, order)
    merge_latest(table, incoming.where("l_shipdate >= DATE'1998-01-01'"), keys, order)
    table.vacuum()
    return table.read()


@register("upsert_null_keys")
def upsert_null_keys(spark, sf_dir):
    """M1 insert-only where a third of the keys are null in part: a null is a
    key like others, so rows under it are new once and a rerun appends nothing."""
    from ..sources.versions import VersionedTable, insert_new

    table = VersionedTable(spark, scratch_path(spark, "null-keys"))
    key = F.expr("CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END").alias("l_orderkey")
    halves = [h.select(key, *(c for c in _LI_COLS if c != "l_orderkey")) for h in _lineitem_split(spark, sf_dir)]
    keys = ["l_orderkey", "l_linenumber", "l_suppkey"]
    insert_new(table, halves[0], keys)
    insert_new(table, halves[1], keys)
    assert insert_new(table, halves[1], keys) == 0
    return table.read()


@register("partitioned_scan")
def partitioned_scan(spark, sf_dir):
    """M2: orders written partitioned by year; reading one year prunes the
    other folders (PartitionFilters in the scan)."""
    from ..sources.bridge import read_table

    path = scratch_path(spark, "orders-by-year")
    orders = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    upsert.write_partitioned(orders, path, ["year"], spread_by="o_orderkey")
    return spark.read.parquet(path).where("year = 1997")


# --- features, model, dashboard cuts, profiling ---------------------------------------


@register("feat_trailing_avg")
def feat_trailing_avg(spark, sf_dir):
    return features.trailing_season_average(gold_models(spark, sf_dir).ref("fact_results"))


@register("feat_dnf_rate")
def feat_dnf_rate(spark, sf_dir):
    return features.dnf_rate(gold_models(spark, sf_dir).ref("fact_results"))


@register("feat_pace_delta")
def feat_pace_delta(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return features.pace_delta(g.ref("fact_qualifying"), g.ref("fact_results"))


@register("feat_consistency")
def feat_consistency(spark, sf_dir):
    return features.consistency(gold_models(spark, sf_dir).ref("fact_results"))


@register("feat_team_momentum")
def feat_team_momentum(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return features.team_momentum(g.ref("fact_results"), g.ref("dim_races"), width=g.width())


@register("feat_session_weather")
def feat_session_weather(spark, sf_dir):
    from ..sources.bridge import read_table

    return features.session_weather(read_table(spark, sf_dir, "events"))


def _sessions(spark, sf_dir, since=None):
    """Sessions of the races, with their days moved into the days of the feed."""
    races = BridgeSources(spark, sf_dir).silver("race_data_races")
    moved = lambda c: F.expr(f"TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(pmod(datediff({c}, DATE '1970-01-01'), 30)) + ({c} - date_trunc('day', {c}))")
    rows = features.session_intervals(races).withColumn("length", F.expr("ends - starts")).withColumn("starts", moved("starts").cast("timestamp_ntz"))
    rows = rows.withColumn("ends", F.expr("starts + length")).drop("length")
    return rows if since is None else rows.where(F.col("starts") >= F.lit(since).cast("date"))


def _weather_readings(spark, sf_dir):
    return _events(spark, sf_dir).where("event_type = 'purchase'")


@register("feat_weather_in_sessions")
def feat_weather_in_sessions(spark, sf_dir):
    """Readings of the weather feed inside each session's start and
    end, for sessions from a date on."""
    return features.weather_in_sessions(_sessions(spark, sf_dir, since="2024-01-10"), _weather_readings(spark, sf_dir))


def _full_features(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    results = g.ref("fact_results")
    momentum = features.team_momentum(results, g.ref("dim_races"), width=g.width())
    races = _sessions(spark, sf_dir).where("session = 'race'")
    weather = features.weather_in_sessions(races, _weather_readings(spark, sf_dir)).select(F.col("raceid").alias("race_id"), "avg_weather")
    return model.form_features(_season_features(spark, sf_dir), results, momentum, weather, width=g.width())


@register("model_full_features")
def model_full_features(spark, sf_dir):
    """M9: the training table with team momentum and weather."""
    return _full_features(spark, sf_dir)


#: the first season that the rolling validation scores
FIRST_SCORED = 1996


@register("model_plain_errors")
def model_plain_errors(spark, sf_dir):
    """Errors by season of the plain mean of earlier seasons, what a model has to beat."""
    return model.plain_errors(_season_features(spark, sf_dir), FIRST_SCORED)


@register("model_rolling_errors")
def model_rolling_errors(spark, sf_dir):
    """Rolling-origin validation, a model of all earlier seasons for
    each season, its errors beside the plain mean's."""
    return model.rolling_errors(_full_features(spark, sf_dir), list(range(FIRST_SCORED, BRIDGE_SCORE_SEASON + 1)))


# Seasons of the provided data used for training and scoring.
BRIDGE_TRAIN_SEASONS = (1996, 1998, 2000)
BRIDGE_SCORE_SEASON = 2001


def _season_features(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return model.season_features(g.ref("fact_results"), g.ref("fact_qualifying"))


@register("model_season_features")
def model_season_features(spark, sf_dir):
    """M9: the training table; every feature comes from earlier seasons."""
    return _season_features(spark, sf_dir)


@register("model_actual_ranks")
def model_actual_ranks(spark, sf_dir):
    """Standings by season from the actual points, ties sharing a rank."""
    return model.actual_ranks(_season_features(spark, sf_dir))


def _fitted(spark, sf_dir):
    feats = cut_lineage(_season_features(spark, sf_dir))  # the fit reads them many times
    return model.train(feats, BRIDGE_TRAIN_SEASONS), feats


@register("model_predicted_vs_actual")
def model_predicted_vs_actual(spark, sf_dir):
    """GBT fitted on selected seasons, one season scored,
    ranked and compared with its actual points."""
    fitted, feats = _fitted(spark, sf_dir)
    return model.predicted_vs_actual(fitted, feats, BRIDGE_SCORE_SEASON)


@register("model_prediction_properties")
def model_prediction_properties(spark, sf_dir):
    """What holds of any predictions: one row for each driver of the
    season, ranks start at 1, the difference is predicted less actual."""
    fitted, feats = _fitted(spark, sf_dir)
    p = model.predicted_vs_actual(fitted, feats, BRIDGE_SCORE_SEASON)
    return p.agg(
        F.count("*").alias("drivers"), F.count_distinct("driver_id").alias("distinct_drivers"),
        F.min("predicted_rank").cast("bigint").alias("first_rank"), F.round(F.sum("actual_points"), 4).alias("actual_points"),
        F.bool_and(F.abs(F.col("difference") - (F.col("predicted_points") - F.col("actual_points"))) < 1e-9).alias("differences_hold"),
        F.bool_and(F.col("predicted_points").isNotNull()).alias("all_predicted"),
    )


@register("model_feature_importance")
def model_feature_importance(spark, sf_dir):
    fitted, _ = _fitted(spark, sf_dir)
    return model.feature_importances(spark, fitted)


def _master(spark, sf_dir):
    return views.historical_master(gold_models(spark, sf_dir))


@register("trend_championship")
def trend_championship(spark, sf_dir):
    return trends.championship_trend(_master(spark, sf_dir))


@register("trend_circuits")
def trend_circuits(spark, sf_dir):
    return trends.circuit_breakdown(_master(spark, sf_dir))


@register("trend_pit_impact")
def trend_pit_impact(spark, sf_dir):
    return trends.pit_stop_impact(_master(spark, sf_dir))


@register("trend_driver_team")
def trend_driver_team(spark, sf_dir):
    return trends.driver_team_comparison(_master(spark, sf_dir))


@register("profile_fact_results")
def profile_fact_results(spark, sf_dir):
    """Per-column rows and NULLs, exact distinct counts of the keys."""
    return profile.profile(gold_models(spark, sf_dir).ref("fact_results"), "fact_results", ("driver_id", "team_id", "race_id", "year", "status"))


@register("profile_distinct_sorted")
def profile_distinct_sorted(spark, sf_dir):
    """Sorted distinct values of one column."""
    return profile.distinct_sorted(BridgeSources(spark, sf_dir).silver("race_data_results"), "positiontext")


@register("profile_head")
def profile_head(spark, sf_dir):
    """First five rows under a total order (a distributed top-k)."""
    return profile.head(gold_models(spark, sf_dir).ref("dim_races"), 5, ["race_id"])


@register("profile_layer")
def profile_layer(spark, sf_dir):
    """Every Silver table with its row and column counts."""
    src = BridgeSources(spark, sf_dir)
    return profile.layer_inventory(spark, {t: src.silver(t) for t in SOURCE_TABLES})


# --- streaming (replayed session) ----------------------------------------------------------


def _cores(spark) -> int:
    return spark.sparkContext.defaultParallelism


def _events(spark, sf_dir):
    from ..sources.bridge import read_table

    return read_table(spark, sf_dir, "events")


@register("stream_hourly")
def stream_hourly(spark, sf_dir):
    """Replayed feed -> watermark + 1-hour windows per event
    type -> update-mode upsert table; equals the batch aggregate."""
    schema, root = telemetry.scratch_tables(spark, "hourly")
    per = telemetry.land_replay(_events(spark, sf_dir), f"{root}/landing", chunks=6, files_per_slice=_cores(spark))
    q = telemetry.hourly_telemetry(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per), f"{schema}.hourly", f"{root}/ckpt"
    )
    q.awaitTermination()
    return telemetry.read_table_fresh(spark, f"{schema}.hourly").drop("_batch", "window_date")


def _deduped(spark, sf_dir):
    """Every slice delivered twice, the second time as a later batch."""
    schema, root = telemetry.scratch_tables(spark, "dedupe")
    per = telemetry.land_replay(
        _events(spark, sf_dir), f"{root}/landing", chunks=6, redeliver=True, files_per_slice=_cores(spark)
    )
    telemetry.dedupe_into_table(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per),
        f"{schema}.events", f"{schema}.batch_quality", f"{root}/ckpt",
    ).awaitTermination()
    return schema


@register("stream_dedupe_upsert")
def stream_dedupe_upsert(spark, sf_dir):
    """T4: every slice delivered twice; the table still holds each event once."""
    return telemetry.read_table_fresh(spark, f"{_deduped(spark, sf_dir)}.events").drop("event_date", "_key")


@register("stream_batch_quality")
def stream_batch_quality(spark, sf_dir):
    """The suite's report over all batches of the stream."""
    report = telemetry.read_table_fresh(spark, f"{_deduped(spark, sf_dir)}.batch_quality")
    return report.groupBy("check_name", "column_name", "rule").agg(
        F.sum("unexpected_count").alias("unexpected_count"), F.bool_and("success").alias("success"), F.min("first_example").alias("first_example")
    )


@register("stream_two_feeds")
def stream_two_feeds(spark, sf_dir):
    """The slow feed (purchase readings) per 15-minute bucket, joined to
    each event of the fast feed (all others)."""
    schema, root = telemetry.scratch_tables(spark, "feeds")
    ev = _events(spark, sf_dir)
    n = _cores(spark)
    pw = telemetry.land_replay(ev.where("event_type = 'purchase'"), f"{root}/weather", chunks=6, files_per_slice=n)
    pt = telemetry.land_replay(ev.where("NOT event_type <=> 'purchase'"), f"{root}/telemetry", chunks=6, files_per_slice=n)
    telemetry.weather_buckets(
        telemetry.replay_stream(spark, f"{root}/weather", files_per_trigger=pw), f"{schema}.weather", f"{root}/ckpt-weather"
    ).awaitTermination()
    telemetry.telemetry_with_weather(
        telemetry.replay_stream(spark, f"{root}/telemetry", files_per_trigger=pt), f"{schema}.weather", f"{root}/joined",
        f"{root}/ckpt-joined",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/joined")


def _marred(events):
    """The events with faults: some without an id, a time or a value, some types in capitals."""
    lost = lambda c, m: F.when(F.col("event_id") % m != 0, F.col(c))
    return events.select(
        lost("event_id", 101).alias("event_id"), lost("ts", 97).alias("ts"), "user_id",
        F.when(F.col("event_id") % 53 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"),
        lost("value", 89).alias("value"), "props",
    )


def _split(spark, sf_dir):
    """A marred feed, every slice delivered twice, split by the suite."""
    schema, root = telemetry.scratch_tables(spark, "split")
    events = _marred(_events(spark, sf_dir))
    per = telemetry.land_replay(events, f"{root}/landing", chunks=4, redeliver=True, files_per_slice=_cores(spark))
    telemetry.split_into_tables(
        telemetry.replay_stream(spark, f"{root}/landing", files_per_trigger=per, arrival=True),
        f"{schema}.events", f"{schema}.quarantine", f"{schema}.latency", f"{root}/ckpt",
    ).awaitTermination()
    return schema


@register("stream_good_events")
def stream_good_events(spark, sf_dir):
    """What passes the suite, each event once though all came twice."""
    return telemetry.read_table_fresh(spark, f"{_split(spark, sf_dir)}.events").drop("event_date", "_key", "_batch")


@register("stream_quarantine")
def stream_quarantine(spark, sf_dir):
    """What fails it, each event once with the rules that it fails, those
    without an id or a time included."""
    bad = telemetry.read_table_fresh(spark, f"{_split(spark, sf_dir)}.quarantine")
    return bad.withColumn("reasons", F.array_join("reasons", "; ")).drop("event_date", "_key", "_batch")


@register("stream_latency")
def stream_latency(spark, sf_dir):
    """T5: the recorded batches: how many, their rows, and that each has its
    latency from landing to commit."""
    rows = telemetry.read_table_fresh(spark, f"{_split(spark, sf_dir)}.latency")
    return rows.agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.min("batch_id").cast("bigint").alias("first_batch"),
        F.bool_and((F.col("fastest_ms") >= 0) & (F.col("slowest_ms") >= F.col("fastest_ms"))).alias("measured"),
    )


@register("stream_live_feeds")
def stream_live_feeds(spark, sf_dir):
    """Both feeds live, some rows late: each telemetry event with the newest
    weather reading of the ten minutes up to it."""
    schema, root = telemetry.scratch_tables(spark, "live-feeds")
    ev, n = _events(spark, sf_dir), _cores(spark)
    is_weather = F.col("event_type").eqNullSafe(F.lit("purchase"))
    land = {"chunks": 4, "files_per_slice": n, "late": "30 MINUTES", "close": "1 DAY"}
    pw = telemetry.land_replay(ev.where(is_weather), f"{root}/weather", **land)
    pt = telemetry.land_replay(ev.where(~is_weather), f"{root}/telemetry", **land)
    telemetry.live_feeds(
        telemetry.replay_stream(spark, f"{root}/telemetry", files_per_trigger=pt),
        telemetry.replay_stream(spark, f"{root}/weather", files_per_trigger=pw), f"{schema}.joined", f"{root}/ckpt",
    ).awaitTermination()
    out = telemetry.read_table_fresh(spark, f"{schema}.joined")
    return out.select("event_id", "ts", "event_type", "value", "reading_ts", "reading")
