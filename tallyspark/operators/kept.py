"""Tables that are kept and appended to (``INSERT INTO``), with a commit record per batch.

A table is a folder: ``data/<batch>-<attempt>`` holds the rows of one attempt to append a batch, and
``commits/<batch>`` names the attempt that counts. The record is put in place after the attempt's files are
complete, and only if there is none yet, so

- a retried task, stage or job leaves at most files that no record names, which readers never see;
- a batch that is appended again, by a second run or by two runs at once, adds nothing;
- readers see all of a batch or nothing of it.

Renaming a file to a name that is free must be atomic on the shared file system, as it is on HDFS.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.joins import null_safe_anti
from tallyspark.operators.materialize import delete_at_end, file_system
from tallyspark.session import ensure_checkpoint_dir

_BATCH = re.compile(r"[A-Za-z0-9][\w.=-]*")


class KeptTable:
    """The kept table in the folder ``path``; ``schema`` is that of its first batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _record(self, batch: str):
        if not _BATCH.fullmatch(batch):
            raise ValueError(f"a batch is named by a letter or digit and letters, digits and _.=- behind it, not {batch!r}")
        return file_system(self.spark, f"{self.path}/commits/{batch}")

    def committed(self, batch: str) -> bool:
        fs, record = self._record(batch)
        return fs.exists(record)

    def attempts(self) -> list[str]:
        """The attempts that count, one per batch, in the order of the batches' names."""
        fs, folder = file_system(self.spark, f"{self.path}/commits")
        if not fs.exists(folder):
            return []
        records = self.spark.read.option("wholetext", True).text(f"{self.path}/commits")
        return [r[0] for r in sorted(records.select("value", F.col("_metadata.file_name").alias("batch")).collect(), key=lambda r: r[1])]

    def read(self) -> DataFrame:
        """The rows of all committed batches."""
        found = self.attempts()
        if not found:
            raise FileNotFoundError(f"{self.path} has no committed batch")
        return self.spark.read.parquet(*[f"{self.path}/data/{a}" for a in found])

    def append(self, rows: DataFrame, batch: str, key: Sequence[str] = ()) -> bool:
        """Append ``rows`` as ``batch``; False if that batch is committed already, and then nothing is run.

        With ``key`` (``PRIMARY KEY``), rows whose key the table has stay out, NULL equal to NULL; keys that
        ``rows`` holds twice are the caller's to settle. Columns are matched by name; a batch with other
        columns or types than the table's raises before anything is written. An empty batch is committed like any other.
        """
        if self.committed(batch):
            return False
        if found := self.attempts():
            now = self.spark.read.parquet(f"{self.path}/data/{found[0]}")
            if dict(now.dtypes) != dict(rows.dtypes):
                raise ValueError(f"the table has {now.dtypes}, the batch {rows.dtypes}")
            rows = rows.select(now.columns)
            if key:
                rows = null_safe_anti(rows, self.read(), key)
        attempt = f"{batch}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{attempt}")
        return self._commit(batch, attempt)

    def _commit(self, batch: str, attempt: str) -> bool:
        """Put the batch's record in place, unless another attempt has been faster. The record is written
        whole beside it and renamed, which fails if there is one."""
        jvm = self.spark._jvm
        fs, record = self._record(batch)
        written = file_system(self.spark, f"{self.path}/commits/.{attempt}")[1]
        out = fs.create(written, False)
        out.write(bytearray(attempt.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(record.toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(written, record, never)
        except Exception:
            if not fs.exists(record):
                raise
            fs.delete(written, False)
            return False
        return True


def new_table(spark: SparkSession, name: str) -> KeptTable:
    """A new kept table in the session's shared folder, until the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyspark/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return KeptTable(spark, path)
