"""Plain Parquet tables that change in one step.

A table is a folder ``data`` of Parquet files and a folder ``_versions`` of
small manifests, each the list of the files that make up one version (with
the schema, the partition columns and the last batch of each writer). New
files are written first; then one rename puts the next manifest in place, and
only that makes them part of the table. So

* a job that dies half-way leaves files that no manifest names: readers see
  the old version, whole;
* a streaming batch that runs again finds its number in the manifest and
  changes nothing, or finds it missing and writes all of it;
* a merge rewrites the files that hold a touched key and keeps the others.

The manifests pass through the driver: a line a file, never rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage


class VersionConflict(RuntimeError):
    """Another writer put the next version in place first."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    schema: str | None = None
    partition_by: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- storage ---------------------------------------------------------------

    def _hadoop(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._hadoop(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def version(self) -> Version:
        """The newest version; number 0 if there is none."""
        names = [n for n in self._names("_versions") if n.isdigit()]
        if not names:
            return Version()
        p, fs = self._hadoop(f"{self.root}/_versions/{names[-1]}")
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        kept = json.loads(text)
        return Version(kept["number"], kept["schema"], tuple(kept["partition_by"]), tuple(kept["files"]), kept["batches"])

    def _commit(self, v: Version) -> None:
        """Put ``v`` in place, or raise if its number is taken."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        draft, fs = self._hadoop(f"{self.root}/_versions/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps(vars(v)).encode())
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions/{v.number:012d}")
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)  # fails on an existing target
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, target, none)
        except Exception as e:  # py4j has one class for all
            if fs.exists(target):
                fs.delete(draft, False)
                raise VersionConflict(f"version {v.number} of {self.root} is taken") from e
            raise

    def _write(self, df: DataFrame, partition_by: tuple[str, ...]) -> tuple[str, ...]:
        """Write ``df`` into a folder of its own; its files, from ``data`` on."""
        folder = f"w={uuid.uuid4().hex[:12]}"
        if partition_by:  # few files a partition; with AQE a large one is split, small ones share a task
            df = df.hint("rebalance", *partition_by)
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/data/{folder}")
        p, fs = self._hadoop(f"{self.root}/data/{folder}")
        files, names = fs.listFiles(p, True), []
        while files.hasNext():
            path = files.next().getPath().toString()
            if path.endswith(".parquet"):
                names.append(folder + path.split(folder, 1)[1])
        return tuple(sorted(names))

    # --- reading ---------------------------------------------------------------

    def exists(self) -> bool:
        return self.version().number > 0

    def read(self, files: tuple[str, ...] | None = None, file_column: str | None = None) -> DataFrame:
        """The table, or the given ones of its files; with ``file_column`` the file of each row."""
        v = self.version()
        schema = v.struct()
        files = v.files if files is None else files
        if not files:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(file_column, F.lit("")) if file_column else empty
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/data/{f}" for f in files))
        place = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
        return df.select(*(F.col(f"`{f.name}`") for f in schema.fields), *place)

    # --- writing ---------------------------------------------------------------

    def change(
        self, add: DataFrame | None, gone: tuple[str, ...] = (), writer: str = "", batch: int | None = None, partition_by: tuple[str, ...] = (), since: Version | None = None
    ) -> bool:
        """The next version: without the files ``gone``, with the rows of
        ``add``. With a batch number, False and no change if this writer has
        committed it. ``since`` is the version that ``gone`` was taken from."""
        v = since or self.version()
        if batch is not None and v.batches.get(writer, -1) >= batch:
            return False
        if v.number:
            partition_by = v.partition_by
        schema = v.schema or add.schema.json()
        fresh = self._write(add if not v.schema else add.select(*(f"`{f.name}`" for f in v.struct().fields)), partition_by) if add is not None else ()
        lost = set(gone)
        files = tuple(f for f in v.files if f not in lost) + fresh
        batches = v.batches if batch is None else {**v.batches, writer: batch}
        self._commit(replace(v, number=v.number + 1, schema=schema, partition_by=partition_by, files=files, batches=batches))
        return True

    def append(self, df: DataFrame, writer: str = "", batch: int | None = None, partition_by: tuple[str, ...] = ()) -> bool:
        return self.change(df, (), writer, batch, partition_by)

    def in_partitions(self, values: list, v: Version | None = None) -> tuple[str, ...]:
        """Files of the given values of the first partition column."""
        v = v or self.version()
        named = {f"{v.partition_by[0]}={'__HIVE_DEFAULT_PARTITION__' if x is None else x}" for x in values}
        return tuple(f for f in v.files if named & set(f.split("/")))

    def compact(self, least: int = 16) -> int:
        """Put the files of each partition (of the table, if it has none) that
        has ``least`` or more together, as few as their size asks for; how many
        went. One new version, with the same rows: a stream's small batches."""
        v = self.version()
        groups: dict[str, list[str]] = {}
        for f in v.files:
            groups.setdefault("/".join(f.split("/")[1:-1]), []).append(f)
        many = tuple(f for files in groups.values() if len(files) >= least for f in files)
        if many:
            rows = self.read(many)
            self.change(rows if v.partition_by else rows.hint("rebalance"), many, since=v)
        return len(many)

    def vacuum(self, keep: int = 1) -> int:
        """Remove manifests but the newest ``keep`` and the written folders
        that none of those names; how many folders went. For the table's only
        writer: a folder that is being written counts as unnamed."""
        numbers = [n for n in self._names("_versions") if n.isdigit()]
        used: set[str] = set()
        for n in numbers[-keep:]:
            p, fs = self._hadoop(f"{self.root}/_versions/{n}")
            stream = fs.open(p)
            used |= {f.split("/")[0] for f in json.loads(bytes(stream.readAllBytes()).decode())["files"]}
            stream.close()
        for n in numbers[:-keep]:
            p, fs = self._hadoop(f"{self.root}/_versions/{n}")
            fs.delete(p, False)
        old = [f for f in self._names("data") if f not in used]
        for f in old:
            p, fs = self._hadoop(f"{self.root}/data/{f}")
            fs.delete(p, True)
        return len(old)


# --- merges --------------------------------------------------------------------


def meeting(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left`` semi- or anti-joined with the keys of ``right``; a null key is a key."""
    names = [f"__key{i}_{uuid.uuid4().hex[:6]}" for i in range(len(keys))]
    held = right.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)))
    cond = reduce(Column.__and__, (F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)))
    return left.join(held, cond, how)


def touched_files(table: VersionedTable, incoming: DataFrame, keys: list[str]) -> tuple[str, ...]:
    """Files of the table that hold a key of ``incoming``. Only key columns are
    read; the range of the leading key prunes row groups and, where files were
    written by key range, most files."""
    k = keys[0]
    b = incoming.agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.bool_or(F.col(k).isNull()).alias("none")).first()
    held = table.read(file_column="__file").select(*keys, "__file")
    inside = F.lit(False) if b.lo is None else F.col(k).between(F.lit(b.lo), F.lit(b.hi))
    held = held.where(inside | F.col(k).isNull() if b.none else inside)
    hits = meeting(held, incoming, keys, "left_semi").select("__file").distinct().collect()  # a row a file
    names = {r[0].split("/data/", 1)[1] for r in hits}
    return tuple(f for f in table.version().files if f in names)


def merge_latest(table: VersionedTable, incoming: DataFrame, keys: list[str], order: list[str]) -> tuple[int, int]:
    """One row a key, the latest by ``order``, over the table and ``incoming``.
    Files without an incoming key stay as they are; the others are rewritten
    by key range. (files rewritten, files kept)"""
    from .upsert import latest_per_key

    v = table.version()
    if not v.number:
        table.append(latest_per_key(incoming, keys, order).repartitionByRange(*keys))
        return 0, 0
    fresh = cut_lineage(latest_per_key(incoming, keys, order).select(*(f.name for f in v.struct().fields)))
    gone = touched_files(table, fresh, keys)
    merged = latest_per_key(table.read(gone).unionByName(fresh), keys, order)
    table.change(merged.repartitionByRange(*keys), gone, since=v)
    return len(gone), len(v.files) - len(gone)


def insert_new(table: VersionedTable, incoming: DataFrame, keys: list[str]) -> int:
    """Append the rows whose key the table hasn't; how many."""
    v = table.version()
    add, seen = incoming, Observation()
    if v.number:
        add = meeting(incoming, table.read(touched_files(table, incoming, keys)), keys, "left_anti")
    table.change(add.repartitionByRange(*keys).observe(seen, F.count(F.lit(1)).alias("n")), since=v)
    return seen.get["n"]
