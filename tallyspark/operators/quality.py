"""Data-quality checks that the case studies expressed as table constraints.

PRIMARY KEY / UNIQUE / CHECK become reports on a batch: duplicate keys, range-rule
violations, and an accept/reject split with a reason per row. All are aggregates or
windows on the key, so a batch of any size is checked in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present more than once, with their row count (``rows``)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def range_violations(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows breaking ``CHECK (col BETWEEN lo AND hi)`` (NULL counts as breaking)."""
    c = F.col(col)
    return df.where(c.isNull() | ~c.between(lo, hi))


def validate_batch(batch: DataFrame, reference: DataFrame, key: Sequence[str], match: Sequence[str],
                   range_col: str, lo, hi) -> DataFrame:
    """Every batch row with ``reject_reason`` (NULL = accepted), first rule that fails:
    out-of-range ``range_col``; ``match`` columns absent from ``reference`` (a NULL among them is no match); more than one
    otherwise valid row for ``key``.

    Batch and reference are tagged and united, and shuffled once, on ``key`` (which ``match`` must hold). Equal batch
    rows travel once with their number, so a key that is repeated by equal rows is one row.
    """
    columns = batch.columns
    mine = batch.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    ref = reference.select(*match).select(*[F.col(c) if c in match else F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in columns], F.lit(0).cast("bigint").alias("__copies"))
    # united after the batch's own aggregate; both windows below ask for the key's distribution only
    tagged = mine.unionByName(ref).repartition(*key)
    per_match, per_key = Window.partitionBy(*match), Window.partitionBy(*key)
    whole = reduce(and_, [F.col(c).isNotNull() for c in match])
    known = (F.min("__copies").over(per_match) == 0) & whole
    in_range = F.col(range_col).between(lo, hi)
    ok = F.when((F.col("__copies") > 0) & in_range & F.col("__known"), F.col("__copies")).otherwise(F.lit(0))
    reason = (F.when(~in_range | F.col(range_col).isNull(), "rating out of range")
              .when(~F.col("__known"), "unknown key")
              .when(F.col("__valid") > 1, "duplicate key"))
    judged = tagged.withColumn("__known", known).withColumn("__valid", F.sum(ok).over(per_key)).where(F.col("__copies") > 0)
    return judged.select(*columns, reason.alias("reject_reason"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))).alias("__copy")).drop("__copy")
