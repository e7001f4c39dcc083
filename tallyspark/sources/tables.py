"""Lazy access to the parquet tables of one data directory.

Reads are plain ``spark.read.parquet``; Catalyst prunes columns and pushes filters into the
scan of whatever plan is built on top, so nothing is selected eagerly here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators.materialize import Sources, shared

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


class Tables:
    """``Tables(spark, "/path/sf0.1").orders`` → DataFrame over ``orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._sources = Sources(spark)

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        self._sources.use(path)
        df = self._frames.get(name)
        if df is None:
            df = self.spark.read.parquet(path)
            self._frames[name] = df
        return df

    def view(self, name: str, build) -> DataFrame:
        """A derived table shared by many analytics, materialised once per application."""
        return shared(self.spark, self.sf_dir, name, build, self._sources)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        return self.table(name)
