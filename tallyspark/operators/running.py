"""Running totals with the SQL default RANGE frame, skew-safe.

``SUM(x) OVER (PARTITION BY k ORDER BY d)`` gives rows sharing ``d`` one value (the total
through ``d``). We sum per (k, d) first – a partial aggregate – and run the window over
those daily rows, whose count per key is bounded by the number of distinct ``d``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_back


def running_total_by(df: DataFrame, group: Sequence[str], order_col: str, value: str, out: str) -> DataFrame:
    """Per-(group, order_col) totals plus their running sum ``out`` in order of ``order_col``."""
    daily = df.groupBy(*group, order_col).agg(F.sum(value).alias("__step"))
    w = Window.partitionBy(*group).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(*group, order_col, F.col("__step"), F.sum("__step").over(w).alias(out))


def with_running_total(df: DataFrame, group: Sequence[str], order_col: str, value: str, out: str) -> DataFrame:
    """Every row of ``df`` plus the RANGE-frame running total ``out`` (NULL keys form a group,
    NULL order comes first, as in a window)."""
    totals = running_total_by(df, group, order_col, value, out).drop("__step")
    return join_back(df, totals, [*group, order_col])
