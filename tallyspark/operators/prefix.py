"""LAG / LEAD / ROW_NUMBER / running sums by a scan over ranges, whatever a group holds.

``… OVER (PARTITION BY group ORDER BY order)`` puts a group into one task. Here rows are range-partitioned
by (group, order): a group, or a single day of it, that holds most rows is cut into as many ranges as it needs, and every
range goes to one task. The window runs inside a range. What crosses a range's border – the row before its first and
behind its last, and what its first group has counted and summed in front of it – comes from
the *edges*: two rows per range at most, in a second pass; so the window over all ranges
and its broadcast are bounded by the number of partitions, not by the data.

Both passes must see the same ranges, and Spark draws a range partitioning's bounds anew each time it plans one.
So the rows are written with the number of their range, once, and both passes read that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize


def _ranges(df: DataFrame, group: list[str], order: list[str], ranges: int) -> DataFrame:
    """The rows with the number of their range (``__p``), every range in the partition of that number, where
    a window over ``__p`` needs no further shuffle."""
    dealt = materialize(df.repartitionByRange(ranges, *group, *order).withColumn("__p", F.spark_partition_id()), "ranges")
    return dealt.repartitionById(ranges, "__p")


def scan(df: DataFrame, group: Sequence[str], order: Sequence[str], prev: Sequence[str] = (), nxt: Sequence[str] = (),
         number: str | None = None, running: dict[str, str] | None = None, ranges: int | None = None) -> DataFrame:
    """Every row of ``df`` with, over its group in the given order (NULL first; NULL keys form a group):

    - ``prev_<c>`` and ``next_<c>`` of the columns ``prev`` and ``nxt`` (``LAG``, ``LEAD``);
    - ``number``: ``ROW_NUMBER``;
    - per entry of ``running``, output name to column: ``SUM(column)`` up to and including the row (``ROWS``), NULL counting as 0.

    ``order`` should be total within a group, else equal rows come in any order (and may be cut anywhere).
    ``group`` may be empty: then all rows are one group. ``ranges`` defaults to the shuffle partitions.
    """
    group, order, running = list(group), list(order), running or {}
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy("__p").orderBy(*group, *order)
    mine = Window.partitionBy("__p", *group).orderBy(*order)
    upto = mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    key = F.struct(*[F.col(g) for g in group], F.lit(0).alias("__one"))
    near = F.struct(key.alias("g"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(dict.fromkeys([*prev, *nxt]))])
    place = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*prev, *nxt]))}
    sums = {f"__s{i}": c for i, c in enumerate(running.values())}
    rows = _ranges(df, group, order, ranges).withColumns({
        "__at": F.row_number().over(inside), "__n": F.row_number().over(mine), "__end": F.lead(F.lit(1)).over(inside).isNull(),
        **{s: F.coalesce(F.sum(c).over(upto), F.lit(0)) for s, c in sums.items()},
        **({"__before": F.lag(near).over(inside)} if prev else {}), **({"__behind": F.lead(near).over(inside)} if nxt else {}),
    })
    edges = rows.where((F.col("__at") == 1) | F.col("__end"))  # two rows per range
    carried = edges.groupBy("__p").agg(
        F.max(F.when(F.col("__at") == 1, near)).alias("head"), F.max(F.when(F.col("__end"), near)).alias("tail"),
        F.max(F.when(F.col("__end"), F.struct(F.col("__n").alias("n"), *[F.col(s) for s in sums], (F.col("__n") == F.col("__at")).alias("whole")))).alias("last"))
    border = Window.orderBy("__p")  # a row per range
    # ranges that are whole pieces of one group pass on what they were given; the others start anew
    carried = carried.select("*", F.lag("tail").over(border).alias("__tail_before"), F.lead("head").over(border).alias("__head_behind"),
                             F.lag("last").over(border).alias("__last_before"))
    joined = F.col("__tail_before").isNotNull() & F.col("__tail_before.g").eqNullSafe(F.col("head.g"))
    starts = ~joined | ~F.coalesce(F.col("__last_before.whole"), F.lit(False))
    carried = carried.withColumn("__joined", joined).withColumn("__run", F.sum(starts.cast("int")).over(border))
    run = Window.partitionBy("__run").orderBy("__p")

    def given(c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("__joined"), F.col("__last_before")[c]).otherwise(F.lit(0))).over(run), F.lit(0))

    carried = carried.select("__p", "__tail_before", "__head_behind", given("n").alias("__add_n"), *[given(s).alias(f"__add{s}") for s in sums])
    out = rows.join(F.broadcast(carried), "__p")  # a row per range
    first_group = F.col("__at") == F.col("__n")
    columns = [F.col(f"`{c}`") for c in df.columns]
    for c in prev:
        there = F.when(F.col("__at") == 1, F.col("__tail_before")).otherwise(F.col("__before"))
        columns.append(F.when(there["g"].eqNullSafe(key), there[place[c]]).alias(f"prev_{c}"))
    for c in nxt:
        there = F.when(F.col("__end"), F.col("__head_behind")).otherwise(F.col("__behind"))
        columns.append(F.when(there["g"].eqNullSafe(key), there[place[c]]).alias(f"next_{c}"))
    if number:
        columns.append((F.col("__n") + F.when(first_group, F.col("__add_n")).otherwise(F.lit(0))).cast("bigint").alias(number))
    for s, name in zip(sums, running, strict=True):
        columns.append((F.col(s) + F.when(first_group, F.col(f"__add{s}")).otherwise(F.lit(0))).alias(name))
    return out.select(*columns)
