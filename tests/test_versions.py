"""Versioned Parquet tables: whole changes, merges that touch what changed, null keys."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from paddock.session import scratch_path
from paddock.sources import upsert
from paddock.sources.versions import VersionConflict, VersionedTable, insert_new, merge_latest, touched_files


def _table(spark):
    return VersionedTable(spark, scratch_path(spark, "versions-test"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_change_shows_whole_or_not_at_all(spark, monkeypatch):
    t = _table(spark)
    t.append(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    before = t.version()

    def dies(v):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(t, "_commit", dies)
        with pytest.raises(RuntimeError, match="lost"):
            t.change(spark.createDataFrame([(3, "c")], "k int, v string"), before.files)
    assert t.version() == before and _rows(t.read()) == [(1, "a"), (2, "b")]
    assert t.vacuum() == 1 and _rows(t.read()) == [(1, "a"), (2, "b")]  # what it left is removed


def test_the_second_of_two_writers_is_told(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1,)], "k int")
    t.append(df)
    old = t.version()
    t.append(df)
    with pytest.raises(VersionConflict):
        t.change(df, since=old)
    assert t.read().count() == 2


def test_a_batch_counts_once(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1,)], "k int")
    assert t.append(df, "s", 0) and t.append(df, "s", 1) and t.append(df, "other", 0)
    assert not t.append(df, "s", 1) and not t.append(df, "s", 0)
    assert t.read().count() == 3


def test_partitions_nulls_and_an_empty_table(spark):
    t = _table(spark)
    assert not t.exists()
    t.append(spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-01-02")], "k int, d string").withColumn("d", F.to_date("d")), partition_by=("d",))
    assert t.read().schema.simpleString() == "struct<k:int,d:date>"
    assert [r.k for r in t.read(t.in_partitions([None])).collect()] == [2]
    assert [r.k for r in t.read(t.in_partitions(["2024-01-02"])).collect()] == [3]
    t.change(None, t.version().files)
    assert t.read().collect() == [] and t.read(file_column="f").columns == ["k", "d", "f"]


def test_merge_rewrites_touched_files_only(spark):
    rng = random.Random(1)
    t = _table(spark)
    rows = [(k, 0, f"v{k}") for k in range(4000)] + [(None, 0, "none")]
    df = spark.createDataFrame(rows, "k int, version int, v string")
    merge_latest(t, df.repartitionByRange(8, "k"), ["k"], ["version"])
    for f in range(3):  # more files, each of its own range
        t.append(spark.createDataFrame([(10_000 * (f + 1) + i, 0, "far") for i in range(50)], df.schema).coalesce(1))
    before = t.version().files
    new = [(k, 1, "new") for k in rng.sample(range(100), 40)] + [(20_007, 1, "new"), (None, 1, "some"), (-5, 1, "below")]
    incoming = spark.createDataFrame(new, df.schema)
    touched = touched_files(t, incoming, ["k"])
    rewritten, kept = merge_latest(t, incoming, ["k"], ["version"])
    after = t.version().files
    assert set(before) - set(after) == set(touched) and rewritten == len(touched) and kept == len(before) - rewritten
    far = [f for f in before if f in after]
    assert len(far) >= 2 and len(far) == kept
    want = {k: (ver, v) for k, ver, v in rows}
    want |= {10_000 * (f + 1) + i: (0, "far") for f in range(3) for i in range(50)}
    want |= {k: (ver, v) for k, ver, v in new}
    assert {r.k: (r.version, r.v) for r in t.read().collect()} == want
    # an older row changes nothing
    merge_latest(t, spark.createDataFrame([(20_007, 0, "old")], df.schema), ["k"], ["version"])
    assert {r.k: (r.version, r.v) for r in t.read().collect()} == want
    t.vacuum()
    assert {r.k: (r.version, r.v) for r in t.read().collect()} == want


def test_merge_reads_few_files(spark):
    t = _table(spark)
    for f in range(4):
        t.append(spark.createDataFrame([(1000 * f + i, "x") for i in range(100)], "k int, v string").coalesce(1))
    incoming = spark.createDataFrame([(2005, "y")], "k int, v string")
    touched = touched_files(t, incoming, ["k"])
    plan = t.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert len(touched) == 1 and "InMemoryFileIndex(1 paths)" in plan


def test_inserting_twice_is_inserting_once_with_null_keys(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (None, 2, "c")], "a int, b int, v string")
    assert insert_new(t, df, ["a", "b"]) == 3
    assert insert_new(t, df, ["a", "b"]) == 0
    assert insert_new(t, spark.createDataFrame([(None, None, "z"), (None, 3, "d")], df.schema), ["a", "b"]) == 1
    assert _rows(t.read().select("v")) == [("a",), ("b",), ("c",), ("d",)]


def test_catalog_upserts_know_null_keys_and_clean_up(spark):
    s = "t_" + uuid.uuid4().hex[:8]
    root = scratch_path(spark, s)
    spark.sql(f"CREATE SCHEMA {s} LOCATION '{root}'")
    df = spark.createDataFrame([(None, 1, "a"), (1, 1, "b")], "k int, ver int, v string")
    assert upsert.upsert_insert_only(spark, f"{s}.i", df, ["k"]) == 2
    assert upsert.upsert_insert_only(spark, f"{s}.i", df, ["k"]) == 0
    for i in range(4):
        upsert.upsert_latest(spark, f"{s}.t", df.withColumn("ver", F.lit(i)), ["k"], ["ver"])
    assert _rows(spark.table(f"{s}.t")) == [(1, 3, "b"), (None, 3, "a")]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/t__v*")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert len(fs.globStatus(p)) == 2  # the last, and the one that readers may hold


def test_small_files_are_put_together(spark):
    t = _table(spark)
    for i in range(6):
        df = spark.createDataFrame([(i, "a"), (i, None), (i + 10, "b")] if i else [(0, "c")], "k int, d string")
        t.append(df, "s", i, partition_by=("d",))
    want, files = _rows(t.read()), set(t.version().files)
    assert t.compact(6) == 0
    assert t.compact(5) == 15 and t.compact(5) == 0
    after = t.version()
    assert _rows(t.read()) == want and after.batches == {"s": 5} and not t.append(t.read(), "s", 5)
    assert len(after.files) == 4 and len(files & set(after.files)) == 1  # the partition of one file stays
    t.vacuum()
    assert _rows(t.read()) == want
