"""Layers (schemas), sinks and views.

A layer is a catalog schema (bronze, silver, gold, dashboard). On a
cluster the schemas live under the shared warehouse; ``base_location``
pins them to a folder (tests use the shared checkpoint folder).

``build_silver``, ``silver_gate``, ``build_gold``, ``gold_gate`` and
``create_dashboard_views`` run in that order, one Spark job per table.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import to_silver
from ..operators.quality import GOLD_SUITES, check_states, check_table, check_tables, gate, merge_states, table_verdicts
from ..plans import views
from ..plans.gold import GOLD_MODELS, GoldModels
from ..session import broadcasts, dropped_shuffles, file_bytes, join_width, tune_joins
from .registry import CatalogSources
from .schemas import QUARANTINE
from .versions import VersionedTable

LAYERS = ("bronze", "silver", "gold", "dashboard")


def create_layers(spark: SparkSession, names: Iterable[str], base_location: str | None = None) -> None:
    for n in names:
        loc = f" LOCATION '{base_location.rstrip('/')}/{n}'" if base_location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n}{loc}")


def reset_layer(spark: SparkSession, name: str, base_location: str | None = None) -> None:
    """Drop a layer with its tables and create it empty."""
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    create_layers(spark, [name], base_location)


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    """The tables of a schema, without the quarantines beside them."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and not t.name.endswith(QUARANTINE))


def table_format(spark: SparkSession) -> str:
    """``delta`` when the Delta Lake classes are on the classpath, else ``parquet``."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return "delta"
    except Exception:  # noqa: BLE001 - jar absent
        return "parquet"


def send_to_schema(
    df: DataFrame,
    table: str,
    schema: str,
    partition_by: list[str] | None = None,
    together: bool = False,
) -> None:
    """Overwrite ``schema.table`` (Delta where that jar is present, else
    Parquet). With ``partition_by`` a filter on those columns prunes folders;
    the rows of a folder come together first, a large one in several tasks, so
    there are few files and not one for each task and folder (``together``: they
    already are)."""
    fmt = table_format(df.sparkSession)
    if partition_by and not together:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{schema}.{table}")


def _concurrently(fn, items, workers: int) -> list:
    """Run independent Spark jobs from driver threads (one job per item)."""
    if workers <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(fn, items))


def stamp(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def write_layer(tables: dict[str, DataFrame], schema: str, workers: int = 4) -> list[str]:
    """Write several tables of one layer as concurrent jobs."""
    for df in tables.values():
        tune_joins(df.sparkSession)

    def one(name: str) -> str:
        send_to_schema(tables[name], name, schema)
        return name

    with ExitStack() as steps:
        for spark in {id(df.sparkSession): df.sparkSession for df in tables.values()}.values():
            steps.enter_context(dropped_shuffles(spark))
        return _concurrently(one, sorted(tables), workers)


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    tables: Iterable[str] | None = None,
    workers: int = 4,
) -> list[str]:
    """Bronze -> Silver for each table (concurrent jobs), stamped with
    ``transformed_at``."""
    tune_joins(spark)
    names = list(tables) if tables is not None else list_tables(spark, bronze)

    def one(t: str) -> str:
        df = to_silver(spark.table(f"{bronze}.{t}").drop("ingested_at"), t)
        send_to_schema(stamp(df, "transformed_at"), t, silver)
        return t

    with dropped_shuffles(spark):
        return _concurrently(one, names, workers)


def validate_layer(spark: SparkSession, schema: str) -> tuple[DataFrame, DataFrame]:
    """Run the suites over every table of a layer; returns the check
    report and the passed/failed verdict per table."""
    report = check_tables(CatalogSources(spark, schema), list_tables(spark, schema))
    return report, table_verdicts(report)


def check_parts(store: VersionedTable, df: DataFrame, table: str, part: Column, parts: list[str | None] | None = None) -> DataFrame:
    """V13 by part: check the given parts of ``df`` (all for None), put their
    states in the place of earlier ones and return the report of all parts. The
    filter on the part prunes folders where the table is partitioned by it; a
    run that dies leaves the states as they were."""
    v = store.version()
    if parts is not None:
        name = part.cast("string")
        inside = name.isin([p for p in parts if p is not None])
        df = df.where(inside | name.isNull() if None in parts else inside)
    gone = (store.in_partitions(parts, v) if parts is not None else v.files) if v.number else ()
    store.change(check_states(df, table, part), gone, partition_by=("part",), since=v)
    return merge_states(store.read())


def silver_gate(spark: SparkSession, silver: str, tables: Iterable[str]) -> DataFrame:
    """Run the suites on Silver; raise if any check failed, else return the report."""
    report = check_tables(CatalogSources(spark, silver), list(tables))
    with dropped_shuffles(spark):
        gate(report)
    return report


def build_gold(
    spark: SparkSession, silver: str, gold: str, models: Iterable[str] = GOLD_MODELS, workers: int = 4
) -> list[str]:
    """Write every Gold model: first the race dimension, which other models
    refer to and then read as a table, then large models in turn, the largest
    first, so that the shuffles of one at a time are on disk, and the rest as
    concurrent jobs. Facts are partitioned by season (rows are spread within a
    season by the writing tasks, so a long season is no single task)."""
    src = CatalogSources(spark, silver)
    g = GoldModels(lambda name: src(name).drop("transformed_at", "ingested_at"), together="year")
    names = list(models)

    def one(m: str) -> str:
        if m.startswith("fact_"):
            send_to_schema(g.ref(m), m, gold, partition_by=["year"], together=True)
        else:
            send_to_schema(g.ref(m), m, gold)
        return m

    with dropped_shuffles(spark):
        if "dim_races" in names:
            one("dim_races")
            g.use("dim_races", spark.table(f"{gold}.dim_races"))
        rest = [m for m in names if m != "dim_races"]
        size = {m: file_bytes(g.ref(m)) for m in rest}  # build plans on the driver thread first
        large = [m for m in sorted(rest, key=size.get, reverse=True) if join_width(g.ref(m))]
        for m in large:
            one(m)
        _concurrently(one, [m for m in rest if m not in large], workers)
    return names


def gold_gate(spark: SparkSession, gold: str) -> DataFrame:
    """Run the Gold suites on the written tables; raise if any check failed."""
    parts = [check_table(spark.table(f"{gold}.{m}"), m, checks) for m, checks in sorted(GOLD_SUITES.items())]
    report = reduce(DataFrame.unionByName, parts)
    with dropped_shuffles(spark):
        gate(report)
    return report


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: the dimensions of the master view, with the keys that they share with the fact or the race
DIMENSIONS = {"d": ("dim_drivers", "driver_id"), "t": ("dim_teams", "team_id"), "c": ("dim_circuits", "circuit_id")}


def create_dashboard_views(spark: SparkSession, gold: str, dashboard: str) -> list[str]:
    """Persistent ``CREATE OR REPLACE VIEW``s in the dashboard schema
    over the Gold tables; the subset views select from the master view, so
    reading them inlines it and Catalyst prunes what they do not use.

    As in ``views.historical_master`` a driver or a team that is broadcast (as
    its table is now) meets the fact last, and all else joins it by race in one
    width. The fact is wide here, so it isn't shuffled for a team: the team meets
    the pairs of race and team, and these the fact."""
    tune_joins(spark)
    width = join_width(spark.table(f"{gold}.fact_results"))
    spread_by = lambda key: f"/*+ REPARTITION({f'{width}, ' if width else ''}{key}) */"
    by_race, by_team = spread_by("race_id"), spread_by("team_id")
    few = [s for s, (table, _) in DIMENSIONS.items() if width and broadcasts(spark.table(f"{gold}.{table}"))]
    last = [s for s in ("d", "t") if s in few]
    paired = ["t"] if width and "t" not in few else []
    first = [s for s in ("d", "t") if s not in last + paired]
    carried = {s: "".join(f", {src} AS {s}_{src[2:]}" for src, _ in views.MASTER_COLUMNS if src.startswith(f"{s}.")) for s in views.CARRIED}
    joins = {s: f" JOIN {gold}.{table} {s} ON {{}}.{key} = {s}.{key}" for s, (table, key) in DIMENSIONS.items()}
    of = lambda src: src if src[0] in last + paired else views.joined_column(src)
    hint = lambda sides: f"/*+ BROADCAST({', '.join(sides)}) */ " if sides else ""
    races = f"SELECT {hint([s for s in few if s == 'c'])}r.*{carried['c']} FROM {gold}.dim_races r{joins['c'].format('r')}"
    pairs = (
        f" JOIN (SELECT {by_race} p.race_id, t.* FROM (SELECT DISTINCT race_id, team_id FROM (SELECT {by_team} race_id, team_id FROM {gold}.fact_results)) p"
        + f" JOIN (SELECT {by_team} team_id, nationality FROM {gold}.dim_teams) t ON p.team_id = t.team_id) t ON fr.race_id = t.race_id AND fr.team_id = t.team_id"
    )
    master_sql = (
        f"SELECT {hint(last)}" + ", ".join(f"{of(src)} AS {_q(name)}" for src, name in views.MASTER_COLUMNS)
        + f" FROM (SELECT {by_race} fr.*{''.join(carried[s] for s in first)} FROM {gold}.fact_results fr"
        + "".join(joins[s].format("fr") for s in first)
        + f") fr JOIN (SELECT {by_race} * FROM ({races})) r ON fr.race_id = r.race_id"
        + f" LEFT JOIN (SELECT {by_race} * FROM {gold}.standings_drivers) sd ON fr.race_id = sd.race_id AND fr.driver_id = sd.driver_id"
        + f" LEFT JOIN (SELECT {by_race} * FROM {gold}.standings_teams) st ON fr.race_id = st.race_id AND fr.team_id = st.team_id"
        + (pairs if paired else "")
        + "".join(joins[s].format("fr") for s in last)
    )
    master = f"{dashboard}.historical_master"
    defs = {
        "historical_master": master_sql,
        "historical_overview": f"SELECT {', '.join(map(_q, views.OVERVIEW_COLUMNS))} FROM {master}",
        "historical_drivers_teams": f"SELECT {', '.join(map(_q, views.DRIVERS_TEAMS_COLUMNS))} FROM {master}",
        "historical_seasons": f"SELECT DISTINCT {', '.join(map(_q, views.SEASON_COLUMNS))} FROM {master}",
    }
    defs["historical_incidents"] = (
        f"SELECT {', '.join(views.cells_sql(views.INCIDENT_CELLS))} FROM {gold}.event_race_incidents"
        f" UNION ALL SELECT {', '.join(views.cells_sql(views.ACCIDENT_CELLS))} FROM {gold}.event_fatal_accidents"
    )
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE VIEW {dashboard}.{name} AS {body}")
    return list(defs)
