"""Column-expression plumbing.

Rules are composed as Spark SQL expression text and turned into a
Column with one ``F.expr`` call: a rule that would take hundreds of
Python -> JVM calls when assembled from ``F.when``/``F.lit`` becomes a
single parse, and Catalyst sees the same expression tree either way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ident(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def lit_sql(value) -> str:
    """SQL literal for a str/None/number."""
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def col_sql(c) -> str:
    """SQL text for a column given by name; Columns are not accepted."""
    if not isinstance(c, str):
        raise TypeError("pass a column name; rules compose SQL expression text")
    return ident(c)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
