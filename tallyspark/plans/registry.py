"""Registry of every analytic key and its Spark builder (their DuckDB oracle texts: `oracle_texts`, beside the package)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.plans import balances, loyalty, orders, retail, subscriptions, web
from tallyspark.sources.tables import Tables

MODULES = [loyalty, orders, subscriptions, balances, retail, web]


def _bind(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))
    run.__doc__ = getattr(fn, "__doc__", None)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in MODULES:
        for k, fn in m.QUERIES.items():
            out[k] = _bind(fn)
    return out


def build_views(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Builders of every shared intermediate view, keyed by name (for timing them apart)."""
    out: dict[str, Callable[[], DataFrame]] = {}
    for m in MODULES:
        for k, fn in getattr(m, "VIEWS", {}).items():
            out[k] = (lambda f: lambda: f(Tables(spark, sf_dir)))(fn)
    return out
