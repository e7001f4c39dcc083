"""Materialise an intermediate result as parquet in the session's checkpoint folder.

The case studies keep cleaned tables and intermediate results as temp tables
(``CREATE TEMP TABLE … AS``, ``SELECT … INTO``); here they become parquet written once
to the shared folder named by ``spark.checkpoint.dir``. That cuts the lineage (a lost
executor re-reads the table instead of recomputing the raw scans and joins), and every
branch of a later plan reads the small typed table instead of re-running its upstream.

Shared views are memoised per application with the *token* of every source table that they were built
from, and built anew when one of those tokens changes; other tables don't matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

CONF_ENABLED = "spark.tallyspark.materialize"
_SHARED: dict[tuple[str, str, str], tuple[dict[str, tuple], DataFrame]] = {}


def enabled(spark: SparkSession) -> bool:
    return spark.conf.get(CONF_ENABLED, "true").lower() == "true"


def file_system(spark: SparkSession, path: str):
    """The path's file system and Hadoop path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the application ends."""
    fs, p = file_system(spark, path)
    fs.deleteOnExit(p)


def change_token(spark: SparkSession, path: str) -> tuple:
    """Changes whenever a file below ``path`` comes, goes, grows or is written anew.

    A table that is one file costs two calls. A folder is listed by Spark, in parallel for many
    directories, and its names, lengths and times are summed up by a job; the driver gets one row, however many files there are.
    """
    fs, p = file_system(spark, path)
    status = fs.getFileStatus(p)
    if status.isFile():
        return status.getLen(), status.getModificationTime()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.bit_xor(seen)).first())


class Sources:
    """The tokens of the paths that one query reads, each taken once, and what is read while a
    view is built."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tokens: dict[str, tuple] = {}
        self._open: list[dict[str, tuple]] = []

    def token(self, path: str) -> tuple:
        if path not in self._tokens:
            self._tokens[path] = change_token(self.spark, path)
        return self._tokens[path]

    def use(self, path: str) -> None:
        """Note that ``path`` is read; its token is taken now, before the rows are."""
        for read in self._open:
            read[path] = self.token(path)

    @contextmanager
    def recorded(self) -> Iterator[dict[str, tuple]]:
        read: dict[str, tuple] = {}
        self._open.append(read)
        try:
            yield read
        finally:
            self._open.pop()


def materialize(df: DataFrame, name: str = "result") -> DataFrame:
    """Write ``df`` once (parquet, shared checkpoint folder) and return a frame reading it. The
    folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyspark/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    delete_at_end(spark, path)
    return spark.read.parquet(path)


def shared(spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame], sources: Sources | None = None) -> DataFrame:
    """The materialised view ``name`` of the data in ``scope`` (built on first use in this application, and
    again when what it reads changes), or the lazy plan itself when materialisation is switched off.

    ``build`` notes what it reads in ``sources``; without them all files below ``scope`` count.
    """
    if not enabled(spark):
        return build()
    mine = sources or Sources(spark)
    key = (f"{spark.sparkContext.applicationId}/{id(spark)}", scope, name)
    inputs, frame = _SHARED.get(key, ({}, None))
    if frame is None or any(mine.token(p) != t for p, t in inputs.items()):
        with mine.recorded() as inputs:
            if sources is None:
                mine.use(scope)
            frame = materialize(build(), name)
        _SHARED[key] = inputs, frame
    for p in inputs:
        mine.use(p)
    return frame
