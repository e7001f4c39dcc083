"""Ordered results of any size, kept in files.

``ORDER BY`` over a large result is only worth its sort if the order outlives the query. Rows are
range-partitioned and sorted inside partitions, so no task holds more than its range, and written as
one Parquet file per range; file names follow the ranges. A *manifest* (one row per file: its
number, rows and the rows before it) makes the order usable afterwards: every row's dense position is its file's
offset plus its place in the file, without a window, and a page of the result reads the files
that hold it only.

Rows that are equal on the whole order are spread by a running id, so one frequent order value
does not fill one file; their order among themselves is then the files' order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

POSITION = "position"


def _file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


class Ordered:
    """An ordered result in the folder ``path``: ``data`` (the files) and ``manifest``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifest(self) -> DataFrame:
        """``file``, ``rows`` and ``before`` (rows of the files in front) of every file that has rows."""
        return self.spark.read.parquet(f"{self.path}/manifest")

    def rows(self) -> DataFrame:
        """Every row with its ``position`` (from 1) in the order."""
        data = self.spark.read.parquet(f"{self.path}/data")
        placed = data.select("*", _file_name().alias("__file"), F.col("_metadata.row_index").alias("__at"))
        files = self.manifest().select(F.col("file").alias("__file"), F.col("before").alias("__before"))
        return placed.join(files, "__file").select((F.col("__before") + F.col("__at") + 1).alias(POSITION), *[F.col(f"`{c}`") for c in data.columns])

    def page(self, offset: int, count: int) -> DataFrame:
        """The rows behind the first ``offset`` rows, ``count`` at most (``OFFSET … FETCH``); reads the
        files that hold them only. The driver sees the names of those files."""
        whole = self.rows()
        inside = (F.col("before") < offset + count) & (F.col("before") + F.col("rows") > offset)
        names = [r["file"] for r in self.manifest().where(inside).select("file").collect()]
        if not names:
            return whole.limit(0)
        data = self.spark.read.schema(whole.drop(POSITION).schema).parquet(*[f"{self.path}/data/{n}" for n in names])
        placed = data.select("*", _file_name().alias("__file"), F.col("_metadata.row_index").alias("__at"))
        files = self.manifest().where(inside).select(F.col("file").alias("__file"), F.col("before").alias("__before"))
        found = placed.join(files, "__file").select((F.col("__before") + F.col("__at") + 1).alias(POSITION), *[F.col(f"`{c}`") for c in data.columns])
        return found.where(F.col(POSITION).between(offset + 1, offset + count)).orderBy(POSITION)


def arranged(df: DataFrame, order: Sequence[str | Column], files: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``order`` (NULL first unless the order says otherwise) and sorted inside partitions."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(files, *keys, "__tie") if files else tied.repartitionByRange(*keys, "__tie")
    return ranged.sortWithinPartitions(*keys, "__tie").drop("__tie")


def write_ordered(df: DataFrame, order: Sequence[str | Column], path: str, files: int | None = None) -> Ordered:
    """Write ``df`` in ``order`` to the new folder ``path``.

    An empty frame gives no rows. The manifest is counted from the files as written, so a task that ran
    twice is counted once. Its running total is over one row per file.
    """
    spark = df.sparkSession
    arranged(df, order, files).write.parquet(f"{path.rstrip('/')}/data")
    data = spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}/data")
    per_file = data.select(_file_name().alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_file.select("file", "rows", before.alias("before")).write.parquet(f"{path.rstrip('/')}/manifest")
    return Ordered(spark, path)


def kept_in_order(df: DataFrame, order: Sequence[str | Column], name: str) -> Ordered:
    """`write_ordered` to the session's shared folder, until the application ends."""
    from tallyspark.operators.materialize import delete_at_end

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tallyspark/{name}-{uuid.uuid4().hex}"
    delete_at_end(df.sparkSession, path)
    return write_ordered(df, order, path)
