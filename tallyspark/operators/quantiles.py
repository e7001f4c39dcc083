"""Exact ``PERCENTILE_CONT`` for integer-valued measures, by refining value ranges.

``percentile(x, p)`` grouped by a key keeps every value of a group in one buffer, so a
group holding a third of the rows holds a third of the data in one task. Here rows are first counted
per (group, value) by partial aggregation, which spreads a group over its values. Values then fall into
ranges by their high bits; a window over the counts of at most 2^16 ranges of a group finds the range that
holds a rank, and only the counts of that range are looked at again, by the next 16 bits,
until single values are left. No task gets more than 2^16 rows of a group, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tallyspark.operators.joins import join_back

#: Bits of a value that one refinement decides.
STEP = 16
BITS = {ByteType(): 8, ShortType(): 16, IntegerType(): 32, LongType(): 64}


def _shifted(c: str, bits: int):
    return F.shiftright(c, bits) if bits else F.col(c)


def values_at(counts: DataFrame, group: Sequence[str], ranks: DataFrame, bits: int) -> DataFrame:
    """The value at a rank. ``counts`` has ``group``, ``__v`` (a long of ``bits`` bits) and ``__c``, how often it occurs; ``ranks`` has
    ``group``, ``__name`` and ``__rank`` (from 0). Returns ``group``, ``__name``, ``__v``."""
    wanted = ranks.select(*group, "__name", "__rank")
    inside = list(group)  # the range found so far, with its group
    for shift in range(max(bits - STEP, 0), -1, -STEP):
        at = counts.select(*group, *([_shifted("__v", shift + STEP).alias("__in")] if len(inside) > len(group) else []), _shifted("__v", shift).alias("__range"), "__c")
        per = at.groupBy(*inside, "__range").agg(F.sum("__c").alias("__c"))
        if len(inside) > len(group):  # other ranges hold no rank
            per = join_back(per, wanted.select(*inside).distinct(), inside)
        upto = Window.partitionBy(*inside).orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per = per.withColumn("__upto", F.sum("__c").over(upto))
        hit = (F.col("__upto") - F.col("__c") <= F.col("__rank")) & (F.col("__rank") < F.col("__upto"))
        wanted = join_back(wanted, per, inside).where(hit).select(
            *group, "__name", (F.col("__rank") - (F.col("__upto") - F.col("__c"))).alias("__rank"), F.col("__range").alias("__in"))
        inside = [*group, "__in"]
    return wanted.select(*group, "__name", F.col("__in").alias("__v"))


def percentile_cont(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float],
                    scale: int = 4) -> DataFrame:
    """One row per group with a ``decimal(24, scale)`` column per entry of ``probs``; NULL values don't count,
    and a group without values has no row. ``value`` is of an integer type."""
    group = list(group)
    bits = BITS[df.schema[value].dataType]
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("bigint").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    n = counts.groupBy(*group).agg(F.sum("__c").alias("__n"))
    pos = {name: (F.col("__n") - 1).cast("decimal(38,0)") * F.lit(Decimal(str(p))) for name, p in probs.items()}
    ends = [F.struct(F.lit(f"{end}{name}").alias("__name"), f(pos[name]).cast("bigint").alias("__rank")) for name in probs for end, f in (("l", F.floor), ("h", F.ceil))]
    ranks = n.select(*group, F.explode(F.array(*ends)).alias("r")).select(*group, "r.__name", "r.__rank")
    found = values_at(counts, group, ranks, bits).groupBy(*group).agg(
        *[F.max(F.when(F.col("__name") == f"{end}{name}", F.col("__v"))).alias(f"__{end}_{name}") for name in probs for end in "lh"])
    per = join_back(n, found, group)
    outs = []
    for name in probs:
        lo, hi, frac = F.col(f"__l_{name}"), F.col(f"__h_{name}"), pos[name] - F.floor(pos[name])
        outs.append((lo + frac * (hi - lo)).cast(f"decimal(24,{scale})").alias(name))
    return per.select(*group, *outs)
