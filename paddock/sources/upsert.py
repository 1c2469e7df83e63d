"""Keyed upserts and partitioned writes on plain Parquet tables.

``MERGE INTO`` needs a table format with row-level writes; on Parquet the
same results come from joins and aggregates:

* insert-only: rows whose key is new (``left_anti`` join) are appended;
  rerunning with the same input appends nothing.
* latest-wins: old and new rows unioned, then one row per key chosen by
  ``max(struct(order..., rest...))`` - an aggregate with a map-side
  partial step, so a key holding a third of all rows is reduced inside
  each task before the shuffle (a window would put it in one task). Ties
  on the order columns break on the remaining columns, deterministically.
  The result is written beside the table, whose location then changes,
  because a table cannot be overwritten while it is being read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .versions import meeting


def new_rows(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is absent from the target; a null key is a key."""
    return meeting(incoming, target, keys, "left_anti")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_latest")
    return df.groupBy(*keys).agg(F.max(packed).alias("_latest")).select(
        *keys, *[F.col(f"_latest.{c}").alias(c) for c in order + rest]
    ).select(*df.columns)


def upsert_insert_only(spark: SparkSession, table: str, incoming: DataFrame, keys: list[str]) -> int:
    """Append rows with new keys to ``table`` (created if missing); returns
    the number of appended rows, counted as they are written."""
    seen = Observation()
    exists = spark.catalog.tableExists(table)
    add = new_rows(spark.table(table), incoming, keys) if exists else incoming
    add.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").saveAsTable(table)
    return seen.get["n"]


def upsert_latest(spark: SparkSession, table: str, incoming: DataFrame, keys: list[str], order: list[str]) -> None:
    """Latest row per key over old + new rows. The result is written beside
    the table, which is then pointed at it in one catalog change: a failure
    before leaves the old table, and readers never miss one."""
    if not spark.catalog.tableExists(table):
        latest_per_key(incoming, keys, order).write.saveAsTable(table)
        return
    merged = latest_per_key(spark.table(table).unionByName(incoming), keys, order)
    place = table_location(spark, table)
    base = place.split("__v")[0].rstrip("/")
    fresh = f"{base}__v{uuid.uuid4().hex[:12]}"
    merged.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    _remove_old(spark, base, {place, fresh})


def _remove_old(spark: SparkSession, base: str, keep: set[str]) -> None:
    """Delete the folders of upserts before the last: readers may still hold that one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{base}__v*")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    for s in fs.globStatus(p) or []:
        if s.getPath().getName() not in names:
            fs.delete(s.getPath(), True)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def write_partitioned(df: DataFrame, path: str, columns: list[str], spread_by: str | None = None) -> None:
    """Partitioned Parquet: a filter on ``columns`` prunes whole folders.

    With ``spread_by`` rows are range-partitioned on (columns..., spread_by)
    first: each task then writes one or two partition folders, and a hot
    partition value is split across many tasks instead of landing in one
    (which hash-partitioning on ``columns`` alone would do).
    """
    if spread_by:
        df = df.repartitionByRange(*columns, spread_by)
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)
