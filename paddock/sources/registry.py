"""Named source registry: table name -> DataFrame, per layer.

``BridgeSources`` serves Bronze and Silver from the provided tables
(derived by ``bridge``); ``CatalogSources`` serves them from tables saved
in the catalog by the ingest and layer sinks. Both memoise, so one plan
references each source once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import to_silver
from . import bridge

# The 18 source tables of the race-data pipeline.
SOURCE_TABLES = tuple(sorted(bridge.BRONZE_BUILDERS))


class BridgeSources:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._bronze: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def bronze(self, name: str) -> DataFrame:
        if name not in self._bronze:
            self._bronze[name] = bridge.bronze(self.spark, self.sf_dir, name)
        return self._bronze[name]

    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = to_silver(self.bronze(name), name)
        return self._silver[name]

    __call__ = silver


class CatalogSources:
    """Tables of one catalog schema (``spark.table``)."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark = spark
        self.schema = schema

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{name}")
