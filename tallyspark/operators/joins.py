"""Joins Spark has no single operator for: point-in-interval (range) join, NULL-aware NOT IN, and joining a
per-key result back to its rows with NULL keys kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 2^23 days are more than the calendar's 9,999 years.
LEVELS = 24
ORIGIN = "0001-01-01"


def join_back(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows JOIN per_key`` on ``keys`` with NULL equal to NULL, as a window's partitions have it
    (an equi-join still: Spark rewrites a null-safe equality to hashable keys)."""
    other = per_key.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    cond = [rows[k].eqNullSafe(other[f"__key_{k}"]) for k in keys]
    return rows.join(other, cond, how).drop(*[f"__key_{k}" for k in keys])


def salted_join_back(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], spread: Sequence[str], weight: str, salts: int | None = None) -> DataFrame:
    """``join_back`` where few keys may hold most of ``rows``: every key has one row in ``per_key``, with the number of
    its rows as ``weight``.

    A key with at least 1/``salts`` of all rows is *hot*: there are ``salts`` of them at most, so their broadcast is bounded
    whatever the data. Rows of a hot key get a salt by a hash of the ``spread`` columns, and the key's row is
    copied once per salt, so the join deals a hot key to many tasks. ``salts`` defaults to the shuffle partitions.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = per_key.agg(F.sum(weight)).scalar()
    hot = F.col(weight) * salts >= total
    marked = per_key.where(hot).select(*keys).withColumn("__hot", F.lit(True))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    dealt = join_back(rows, F.broadcast(marked), keys, "left").withColumn("__salt", salt).drop("__hot")  # at most `salts` rows
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return join_back(dealt, per_key.withColumn("__salt", F.explode(copies)).drop(weight), [*keys, "__salt"]).drop("__salt")


def null_safe_anti(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose ``keys`` are not among those of ``others``, NULL equal to NULL."""
    listed = others.select(*[F.col(k).alias(f"__key_{k}") for k in keys])
    return rows.join(listed, [rows[k].eqNullSafe(listed[f"__key_{k}"]) for k in keys], "left_anti")


def not_in(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """``rows WHERE key NOT IN (SELECT key FROM others)`` by SQL's NULL rule: a NULL among the others
    leaves no row, and a NULL key stays only if there are no others.

    The list is read once: its distinct keys, NULL being one of them, are shuffled once, and both the
    counts and the anti join take them from that exchange. Spark's own ``NOT IN`` is a nested loop
    where the list is too large to broadcast.
    """
    listed = others.groupBy(F.col(key).alias("__in")).agg(F.count(F.lit(1)).alias("__n"))
    facts = listed.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__in").isNull()).alias("nulls"))).scalar()
    kept = (facts["n"] == 0) | ((facts["nulls"] == 0) & F.col(key).isNotNull())
    return rows.join(listed, rows[key] == listed["__in"], "left_anti").where(kept).select(rows.columns)


# -- intervals -----------------------------------------------------------------------------------

def _day(at: Column) -> Column:
    return F.datediff(F.to_date(at), F.lit(ORIGIN).cast("date"))


def _floor(x: Column, level: Column) -> Column:
    """x / 2^level, rounded down."""
    return F.call_function("shiftright", x, level)


def dyadic_cover(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """The whole numbers ``first`` to ``last`` as dyadic nodes: an array of structs ``level``, ``node``, each the numbers
    from node * 2^level to (node + 1) * 2^level - 1. At most two nodes per level, without overlap; empty where last < first.

    At each level what is left is a run of nodes; its first goes into the cover if it is a right half, its
    last if it is a left half, and the rest is whole nodes of the next level.
    """
    def at(level: Column) -> Column:
        low = -_floor(-first, level)  # rounded up
        high = _floor(last + 1, level)  # excluded
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), low)
        right = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), high - 1)
        return F.filter(F.array(F.struct(level.alias("level"), left.alias("node")), F.struct(level.alias("level"), right.alias("node"))), lambda s: s["node"].isNotNull())
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, how: str = "left") -> DataFrame:
    """``points JOIN intervals ON points.at BETWEEN intervals.start AND intervals.end`` (``how``: inner or left).

    An interval becomes the dyadic nodes of its days, two per level at most (so an open one costs no more than 48 rows), and
    a point its ancestors at the levels that intervals have; the two meet at exactly one node, in
    an equi-join, where the exact bounds are checked again. ``points`` are read once. In a left join the
    rows of a point are dealt by an id of it, to keep one where nothing matched.
    Columns of ``intervals`` other than ``start``/``end`` must not clash with those of ``points``.
    """
    known = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    nodes = known.withColumn("__c", F.explode(dyadic_cover(_day(F.col(start)), _day(F.col(end))))).select(
        *intervals.columns, F.col("__c.level").alias("__il"), F.col("__c.node").alias("__in"), F.lit(True).alias("__hit"))
    # no interval at all: one level, so that a left join keeps its points
    used = F.coalesce(known.select(F.explode(dyadic_cover(_day(F.col(start)), _day(F.col(end)))["level"]).alias("l")).agg(F.collect_set("l")).scalar(), F.array().cast("array<int>"))
    levels = F.when(F.size(used) > 0, used).otherwise(F.array(F.lit(0)))
    p = points.withColumn("__id", F.monotonically_increasing_id()) if how == "left" else points
    p = p.withColumn("__pl", F.explode(levels)).withColumn("__pn", _floor(_day(F.col(at)), F.col("__pl")))
    cond = (p["__pl"] == nodes["__il"]) & (p["__pn"] == nodes["__in"]) & (p[at] >= nodes[start]) & (p[at] <= nodes[end])
    found = p.join(nodes, cond, how)
    if how == "left":
        own = Window.partitionBy("__id").orderBy(F.col("__hit").desc_nulls_last())
        found = found.withColumn("__k", F.row_number().over(own)).where(F.col("__hit").isNotNull() | (F.col("__k") == 1)).drop("__id", "__k")
    return found.drop("__pl", "__pn", "__il", "__in", "__hit")
