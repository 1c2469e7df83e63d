"""Table inspection as DataFrames.

``profile`` computes, in one aggregation pass, per column: type, row
count and NULL count, and unpivots it to one row per column. Distinct
counts are exact for the columns named in ``distinct`` (each a grouped
pass of its own; one pass over all would multiply the rows by the number
of columns) or, with ``approx=True``, sketches for every column. ``distinct_sorted`` and ``head``
are the other inspection modes; ``layer_inventory`` lists every table
of a layer with its row and column counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._col import ident, lit_sql


def profile(df: DataFrame, table: str, distinct: Sequence[str] = (), approx: bool = False) -> DataFrame:
    fields = df.schema.fields
    aggs = ["count(1) AS n_rows"]
    for i, f in enumerate(fields):
        c = ident(f.name)
        aggs += [f"count_if({c} IS NULL) AS z{i}", f"{f'approx_count_distinct({c})' if approx else 'CAST(NULL AS BIGINT)'} AS d{i}"]
    rows = ", ".join(
        f"{lit_sql(table)}, {i}, {lit_sql(f.name)}, {lit_sql(f.dataType.simpleString())}, n_rows, z{i}, d{i}"
        for i, f in enumerate(fields)
    )
    out = df.selectExpr(*aggs).selectExpr(
        f"stack({len(fields)}, {rows}) AS (table_name, ordinal, column_name, data_type, row_count, null_count, distinct_count)"
    )
    if not distinct:
        return out
    counts = [
        df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column_name"), "n")
        for c in distinct
    ]
    exact = reduce(DataFrame.unionByName, counts)
    kept = [c for c in out.columns if c != "distinct_count"]
    return out.join(exact, "column_name", "left").select(*kept, F.coalesce("n", "distinct_count").alias("distinct_count"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, ascending (NULL first)."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first())


def head(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-n (each task
    keeps its own n before the final merge)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def layer_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table name, row count and column count for each table (one pass each,
    combined into one job)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
