"""Top-per-group and rank without a window over raw rows.

A window partitioned by a hot key puts every row of that key in one task. When the
order column has few distinct values per group (dates), we instead aggregate first –
map-side partial aggregation splits a hot key across tasks – and join the small
per-group result back; AQE's skew-join splits a hot key on that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_back


def extreme_rows(df: DataFrame, group: Sequence[str], order_col: str, largest: bool = False) -> DataFrame:
    """Rows whose ``order_col`` is the group's minimum (or maximum), ties kept; a NULL
    ``order_col`` is never an extreme, a NULL group is a group."""
    agg = F.max(order_col) if largest else F.min(order_col)
    best = df.groupBy(*group).agg(agg.alias("__best"))
    cond = [df[g].eqNullSafe(best[g]) for g in group] + [df[order_col] == best["__best"]]
    return df.join(best, cond, "left_semi")


def rank_by_value(df: DataFrame, group: Sequence[str], order_col: str, out: str = "rank") -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY order_col)`` as 1 + rows of the group with a
    smaller ``order_col``.

    Counts per (group, value) come from a partial aggregate; the window then runs over
    distinct values only (for dates: at most one row per day per group).
    """
    counts = df.groupBy(*group, order_col).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(*group, order_col,
                          (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("bigint").alias(out))
    return join_back(df, ranks, [*group, order_col])


def top_n(df: DataFrame, n: int, *order: str | object) -> DataFrame:
    """Global top-n by a total order (``ORDER BY … FETCH FIRST n``): TakeOrderedAndProject
    keeps n rows per task and merges them, so nothing larger than n moves."""
    return df.orderBy(*order).limit(n)
