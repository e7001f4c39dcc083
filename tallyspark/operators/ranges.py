"""Aggregates over arbitrary value ranges (a correlated ``COUNT … WHERE value BETWEEN low AND high``).

Rows are counted and summed per distinct value; range bounds are put among the values, and one
running sum over all of them (`prefix.scan`, cut into ranges of the order) gives what lies below
each bound. A range's aggregate is the difference at its two bounds, so equal, unequal, overlapping and
empty ranges all cost two rows each, whatever they cover, and no range is ever joined to its values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.prefix import scan


def range_aggregate(rows: DataFrame, value: str, ranges: DataFrame, low: str, high: str, count: str = "n", total: str = "total") -> DataFrame:
    """Every row of ``ranges`` with the number (``count``) of ``rows`` whose ``value`` lies between its bounds (both included)
    and the sum (``total``, NULL without any) of those values.

    Values and bounds are whole numbers. A NULL value lies in no range; a NULL bound or low > high gives an empty range.
    Equal ranges are kept as often as they come.
    """
    per = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("bigint").alias("__v")).agg(F.count(F.lit(1)).alias("__c"), F.sum(F.col(value).cast("bigint")).alias("__s"))
    # a low bound stands in front of its value, a high one behind it
    known = ranges.where(F.col(low) <= F.col(high)).select(F.col(low).cast("bigint").alias("l"), F.col(high).cast("bigint").alias("h")).distinct()
    ends = known.select(F.explode(F.array(F.struct(F.col("l").alias("v"), F.lit(-1).alias("side")), F.struct(F.col("h").alias("v"), F.lit(1).alias("side")))).alias("e")).distinct()
    nothing = F.lit(0).cast("bigint")
    placed = per.select("__v", F.lit(0).alias("__side"), "__c", "__s").unionByName(
        ends.select(F.col("e.v").alias("__v"), F.col("e.side").alias("__side"), nothing.alias("__c"), nothing.alias("__s")))
    at = scan(placed, [], ["__v", "__side"], running={"__n": "__c", "__t": "__s"}).where(F.col("__side") != 0)
    below = at.where(F.col("__side") == -1).select(F.col("__v").alias(low), F.col("__n").alias("__n0"), F.col("__t").alias("__t0"))
    upto = at.where(F.col("__side") == 1).select(F.col("__v").alias(high), F.col("__n").alias("__n1"), F.col("__t").alias("__t1"))
    some = F.col(low) <= F.col(high)
    out = ranges.join(below, low, "left").join(upto, high, "left")
    n = F.when(some, F.col("__n1") - F.col("__n0")).otherwise(F.lit(0))
    n = F.coalesce(n, F.lit(0)).cast("bigint")
    return out.select(*ranges.columns, n.alias(count), F.when(n > 0, F.col("__t1") - F.col("__t0")).alias(total))
