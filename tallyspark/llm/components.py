"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of ``edges`` (``a``,
    ``b``, longs) that isn't the root itself. The edge table is written to the shared folder
    after every round; rounds grow with the logarithm of the longest path."""
    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "edges")
