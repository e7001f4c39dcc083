"""LAG / LEAD / RANK per group without putting a whole group in one task.

``lag(x) OVER (PARTITION BY customer ORDER BY ts)`` sends every row of a customer to one
task; a customer holding a third of the rows makes that task a third of the job. Both
operators here work in two levels over a *bucket* – columns that coarsen the order (the
date of a timestamp, a leading order column):

1. the window runs per (group, bucket), so a hot group is spread over its buckets;
2. per (group, bucket) the first/last rows (or row counts) are aggregated – a partial
   aggregate – and a window over the *buckets* of each group (a few rows per bucket)
   carries values across bucket boundaries;
3. the bucket-level result is joined back on (group, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_back


def neighbours(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Sequence[str],
               cols: Sequence[str], prev: bool = True, nxt: bool = True) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` = ``LAG/LEAD(c, 1) OVER (PARTITION BY group ORDER BY order)``.

    ``bucket`` must be non-decreasing along ``order`` (e.g. ``[date]`` for order
    ``[date, key]``), and ``order`` should be a total order within each group.
    """
    group, order, bucket, cols = list(group), list(order), list(bucket), list(cols)
    wb = Window.partitionBy(*group, *bucket).orderBy(*order)
    inner = df
    for c in cols:
        if prev:
            inner = inner.withColumn(f"__p_{c}", F.lag(c).over(wb))
        if nxt:
            inner = inner.withColumn(f"__n_{c}", F.lead(c).over(wb))
    inner = (inner.withColumn("__first", F.lag(F.lit(1)).over(wb).isNull())
             .withColumn("__last", F.lead(F.lit(1)).over(wb).isNull()))
    payload = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"v_{c}") for c in cols])
    ends = df.groupBy(*group, *bucket).agg(F.min(payload).alias("__lo"), F.max(payload).alias("__hi"))
    wg = Window.partitionBy(*group).orderBy(*bucket)
    ends = ends.select(*group, *bucket, F.lag("__hi").over(wg).alias("__prev_hi"), F.lead("__lo").over(wg).alias("__next_lo"))
    out = join_back(inner, ends, group + bucket)
    for c in cols:
        if prev:
            out = out.withColumn(f"prev_{c}", F.when(F.col("__first"), F.col("__prev_hi")[f"v_{c}"])
                                 .otherwise(F.col(f"__p_{c}")))
        if nxt:
            out = out.withColumn(f"next_{c}", F.when(F.col("__last"), F.col("__next_lo")[f"v_{c}"])
                                 .otherwise(F.col(f"__n_{c}")))
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def rank_in_order(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Sequence[str],
                  out: str = "rank") -> DataFrame:
    """Add ``out`` = ``RANK() OVER (PARTITION BY group ORDER BY order)`` (bigint), where
    ``bucket`` is non-decreasing along ``order`` and ties of ``order`` never span buckets."""
    group, order, bucket = list(group), list(order), list(bucket)
    wb = Window.partitionBy(*group, *bucket).orderBy(*order)
    inner = df.withColumn("__r", F.rank().over(wb))
    counts = df.groupBy(*group, *bucket).agg(F.count(F.lit(1)).alias("__n"))
    wg = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, *bucket, F.coalesce(F.sum("__n").over(wg), F.lit(0)).alias("__off"))
    res = join_back(inner, offsets, group + bucket)
    return res.withColumn(out, (F.col("__off") + F.col("__r")).cast("bigint")).drop("__r", "__off")


def preceding_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Sequence[str],
                  weight: str, out: str = "preceding") -> DataFrame:
    """Add ``out`` = sum of ``weight`` over the group's rows whose ``order`` is strictly smaller
    (``RANK() - 1`` when every weight is 1). ``bucket`` is non-decreasing along ``order``."""
    group, order, bucket = list(group), list(order), list(bucket)
    keys = list(dict.fromkeys(group + bucket + order))
    at = df.groupBy(*keys).agg(F.sum(weight).alias("__w"))
    wb = Window.partitionBy(*group, *bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = at.select(*keys, F.coalesce(F.sum("__w").over(wb), F.lit(0)).alias("__in"))
    per_bucket = at.groupBy(*group, *bucket).agg(F.sum("__w").alias("__bw"))
    wg = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*group, *bucket, F.coalesce(F.sum("__bw").over(wg), F.lit(0)).alias("__off"))
    sums = join_back(inner, offsets, group + bucket).select(*keys, (F.col("__off") + F.col("__in")).cast("bigint").alias(out))
    return join_back(df, sums, keys)
