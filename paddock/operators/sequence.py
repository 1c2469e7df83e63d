"""Skew-safe "previous n rows" statistics per key.

``Window.partitionBy(key).orderBy(t).rowsBetween(-n, -1)`` sends every
row of a key to one task; a key holding a third of the data then holds a
third of the job. This operator computes the same numbers without any
group larger than one range partition:

1. ``repartitionByRange(key, order...)``: a hot key is split across
   several contiguous, size-balanced partitions.
2. Local position of each row inside its (partition, key) block.
3. Block sizes per (partition, key) -> running offsets per key over the
   partitions (at most one row per partition and key).
4. ``seq = offset + local position``: the row's position in its key's
   sequence, consecutive from 1.
5. The trailing mean is a window inside a block. Only the last n rows of a
   block that its key goes on after are sent to their successors' slots
   (``seq + k``): at most n a range partition, so their sums are broadcast.

Rows must be unique on (key, order...); aggregate first. The
range-partitioned, tagged rows are checkpointed (reliable checkpoint in
``spark.checkpoint.dir``), so the numbering is stable and a lost executor
does not recompute the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def sequence_numbers(df: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``seq``: 1-based position of each row within its key, by ``order``."""
    return _numbered(df, key, order, partitions, {}).drop("_pid", "_local", "_size", "_last")


def _numbered(df: DataFrame, key: str, order: list[str], partitions: int | None, inside: dict[str, Column]) -> DataFrame:
    """``df`` with ``seq``, its place in its block (``_pid``, ``_local`` of
    ``_size``), the key's last block (``_last``) and the columns ``inside``,
    computed over a row's block."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, key, *order).withColumn("_pid", F.spark_partition_id())
    # The partition id must mean the same thing in both branches below;
    # AQE may coalesce the range exchange differently per branch, so the
    # tagged rows are written once to the shared checkpoint folder.
    ranged = cut_lineage(ranged)
    if partitions:  # as many tasks for the numbering
        ranged = ranged.repartition(partitions, "_pid", key)
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_pid", key).orderBy(*order))
    ).withColumns(inside)
    blocks = local.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_size"))
    offsets = blocks.withColumn(
        "_offset",
        F.coalesce(
            F.sum("_size").over(
                Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).withColumn("_last", F.max("_pid").over(Window.partitionBy(key)))
    return local.join(offsets, ["_pid", key]).withColumn("seq", F.col("_offset") + F.col("_local")).drop("_offset")


def trailing_mean(
    df: DataFrame, key: str, order: list[str], value: str, preceding: int, out: str, partitions: int | None = None
) -> DataFrame:
    """Mean of ``value`` over the ``preceding`` rows before each row of the
    same key (NULL for the first row of a key), like a
    ``rowsBetween(-preceding, -1)`` window."""
    before = Window.partitionBy("_pid", key).orderBy(*order).rowsBetween(-preceding, -1)
    rows = _numbered(df, key, order, partitions, {"_sum": F.sum(value).over(before), "_n": F.count(value).over(before)})
    ends = rows.where((F.col("_pid") < F.col("_last")) & (F.col("_local") > F.col("_size") - preceding))
    sent = ends.select(
        F.col(key).alias("_mkey"), "seq", F.col(value).alias("_v"), F.explode(F.sequence(F.col("_size") - F.col("_local") + 1, F.lit(preceding))).alias("_k")
    ).groupBy("_mkey", (F.col("seq") + F.col("_k")).alias("_slot")).agg(F.sum("_v").alias("_sent_sum"), F.count("_v").alias("_sent_n"))
    joined = rows.join(F.broadcast(sent), (F.col(key) == F.col("_mkey")) & (F.col("seq") == F.col("_slot")), "left")
    n = F.col("_n") + F.coalesce("_sent_n", F.lit(0))
    total = F.coalesce("_sum", F.lit(0)) + F.coalesce("_sent_sum", F.lit(0))
    return joined.select(*df.columns, "seq", (total / F.nullif(n, F.lit(0))).alias(out))
