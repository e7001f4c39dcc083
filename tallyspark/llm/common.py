"""Small helpers that the operators share."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

from tallyspark.session import ensure_checkpoint_dir

#: What separates words: blank, tab, newline, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def importable(spark: SparkSession) -> None:
    """Let the Python workers find this package where it isn't installed (a checkout)."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in (path := env.get("PYTHONPATH", "")).split(":"):
        env["PYTHONPATH"] = f"{path}:{root}".strip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again, which cuts its lineage."""
    path = shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _plain_scan(docs: DataFrame) -> bool:
    """Whether each row of the frame is one row of its Parquet files: selections and filters only, no
    join, explode, union or random choice."""
    node = docs._jdf.queryExecution().analyzed()
    while (name := node.nodeName()) != "LogicalRelation":
        if name not in ("Project", "Filter", "SubqueryAlias", "View") or not node.deterministic():
            return False
        node = node.children().head()
    return True


def row_address(docs: DataFrame) -> DataFrame:
    """The frame with ``__file`` and ``__row``, where each row lies in the files it is read from.

    A frame that isn't read straight from Parquet files is written to the shared folder first, anew
    in each call, so addresses of two calls aren't comparable: take them once and hand them on (see `placed_rows`).
    """
    if "_metadata" not in docs.columns and _plain_scan(docs):
        try:
            meta = docs.metadataColumn("_metadata")
            out = docs.select("*", meta["file_path"].alias("__file"), meta["row_index"].alias("__row"))
            out.schema  # resolved now, or not at all
            return out
        except Exception as e:  # analysis: the frame has no such metadata
            if type(e).__name__ not in ("AnalysisException", "UnsupportedOperationException"):
                raise
    hidden = stored(docs.withColumnRenamed("_metadata", "__metadata"), "rows")
    meta = hidden.metadataColumn("_metadata")
    return hidden.select("*", meta["file_path"].alias("__file"), meta["row_index"].alias("__row")).withColumnRenamed("__metadata", "_metadata")


def placed_rows(docs: DataFrame, *columns: Column, placed: bool = False) -> DataFrame:
    """The columns with ``__file`` and ``__row``: new addresses, or those that ``docs`` has (``placed``)."""
    return docs.select(*columns, "__file", "__row") if placed else row_address(docs.select(*columns))


def rows_at(placed: DataFrame, report: DataFrame) -> DataFrame:
    """The rows of ``placed`` (from `row_address`) whose addresses are in ``report``, without the addresses."""
    return placed.join(report.select("__file", "__row"), ["__file", "__row"], "left_semi").drop("__file", "__row")
