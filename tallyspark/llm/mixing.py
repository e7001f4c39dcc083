"""Mixing sources to target weights by Pfair scheduling (operator 4).

The documents of a source, in hash order, are cut into blocks of about ``block_chars`` code points.
Every slot of the mixture takes one block. With target weight w, the k-th block of a source (from 1)
is released at slot floor((k - 1) / w) and must lie before its deadline ceil(k / w); earliest deadline
first among the released blocks meets every deadline on one line of slots whose weights sum to 1.
After any number t of slots a source then has more than t*w - 1 and fewer than t*w + 1 blocks.

Releases and deadlines come from the exact weights, as whole numbers, so the deviation stays under
one block whatever the number of slots and sources. One task lays out the table of slots (one row
per block and epoch, not per document), with a heap of one entry per source, and streams it to the
shared folder; Spark joins the documents to it by source and block. Every document is used: the
mixture ends with the last deadline of the source that needs most slots, and sources that need
fewer start again, as epochs 1, 2, ... of the same blocks.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import importable, stored

#: Slots of a period of weights that are rounded by `whole_parts`; `mix` rounds none.
PARTS = 1000
#: Slots of the schedule that are written at a time.
SLOT_ROWS = 50_000
#: Code points of a block.
BLOCK_CHARS = 100_000
#: Default weights are the sources' sizes to this power.
TEMPERATURE = 0.7
#: Rows of a (source, bucket) group in which positions are numbered.
BUCKET_ROWS = 20_000


def whole_parts(weights: dict, parts: int = PARTS) -> dict:
    """Weights as whole numbers that sum to ``parts``, at least 1 each (largest remainders)."""
    if not weights:
        return {}
    if len(weights) > parts:
        raise ValueError(f"more than {parts} sources: raise parts")
    if any(w is None or not w > 0 for w in weights.values()):
        raise ValueError("a target weight must be positive")
    total = sum(Fraction(w) for w in weights.values())
    exact = {s: Fraction(w) / total * parts for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (-(exact[s] - int(exact[s])), str(s)))
    at = 0
    while (gap := parts - sum(out.values())) != 0:
        s = order[at % len(order)] if gap > 0 else max(out, key=lambda s: (out[s] - exact[s], out[s], str(s)))
        out[s] += 1 if gap > 0 else -1
        at += 1
    return out


def exact_weights(weights: dict) -> dict:
    """Weights as whole numbers in exactly the same proportions."""
    if any(w is None or not w > 0 for w in weights.values()):
        raise ValueError("a target weight must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*(x.denominator for x in exact.values()))
    return {s: x.numerator * (unit // x.denominator) for s, x in exact.items()}


def schedule(parts: dict, slots: int) -> Iterator[tuple]:
    """(source, slot, ordinal of the source's block from 0) of the first ``slots`` slots, for whole weights."""
    size = sum(parts.values())
    waiting = [(0, i, s, 0) for i, s in enumerate(sorted(parts, key=lambda s: (s is not None, str(s))))]
    heapq.heapify(waiting)
    ready: list = []
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, i, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * size // parts[s]), i, k, s))
        deadline, i, k, s = heapq.heappop(ready)
        assert slot < deadline
        yield s, slot, k
        heapq.heappush(waiting, ((k + 1) * size // parts[s], i, s, k + 1))


def period(parts: dict, size: int = PARTS) -> list[tuple]:
    """The schedule of weights that sum to ``size``, up to where it repeats."""
    return list(schedule(parts, size))


def slot_table(spark: SparkSession, share: dict, n_blocks: dict, slots: int) -> DataFrame:
    """The schedule as a table: ``p_source``, ``p_block``, ``p_epoch`` and ``p_slot``."""
    sent = spark.sparkContext.broadcast((share, n_blocks))

    def lay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, n_blocks = sent.value
        for batch in batches:
            for _ in range(batch.num_rows):
                rows = schedule(share, slots)
                while some := list(itertools.islice(rows, SLOT_ROWS)):
                    names, at, k = zip(*some, strict=True)
                    turns = [divmod(x, n_blocks[s]) for x, s in zip(k, names, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([t[1] for t in turns], pa.int64()), pa.array([t[0] for t in turns], pa.int64()), pa.array(at, pa.int64())], ["p_source", "p_block", "p_epoch", "p_slot"])

    return stored(spark.range(1, numPartitions=1).mapInArrow(lay, "p_source string, p_block long, p_epoch long, p_slot long"), "schedule")


def blocks(docs: DataFrame, keep: list[str], source: str, text: str, block_chars: int) -> DataFrame:
    """``keep`` columns, ``__s`` (source; null is a source of its own), ``__block`` (from 0) and
    ``__at`` (place among the source's documents). Sums run over hash buckets first, so no
    source is ever in one task."""
    rows = docs.select(*keep, F.col(source).cast("string").alias("__s"), F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)).cast("long").alias("__n"))
    rows = stored(rows.withColumn("__hash", F.xxhash64(*keep)), "sizes")
    buckets = 1 << max(0, (rows.count() // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("__bucket", F.shiftrightunsigned("__hash", 64 - buckets.bit_length() + 1) if buckets > 1 else F.lit(0).cast("long"))
    sums = rows.groupBy("__s", "__bucket").agg(F.sum("__n").alias("chars"), F.count("*").alias("docs"))
    before = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__s").alias("__s2"), F.col("__bucket").alias("__b2"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("__c0"), F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("__d0"))
    rows = rows.join(sums, F.col("__s").eqNullSafe(F.col("__s2")) & (F.col("__bucket") == F.col("__b2")))
    inside = Window.partitionBy("__s", "__bucket").orderBy("__hash", *keep)
    chars = F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n") + F.col("__c0")
    place = F.row_number().over(inside) - 1 + F.col("__d0")
    return rows.select(*keep, "__s", "__n", chars.alias("__chars"), place.alias("__at")).withColumn("__block", F.floor(F.col("__chars") / block_chars)).drop("__chars")


def mix(docs: DataFrame, weights: dict | None = None, keep: list[str] | None = None, source: str = "source", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Place every document in the mixture: ``keep`` columns (default ``doc_id``), ``source``,
    ``block`` (of its source, from 0), ``slot``, ``epoch`` (0 for the first use) and ``place`` (order
    within the source). Every row has one row of epoch 0, repeated rows too, and one for each
    further epoch.

    ``weights`` maps sources to positive target weights (null is the key None) and must name every
    source; by default they are the sources' total code points to the power `TEMPERATURE`. A null or
    empty text counts as one code point, so it takes a place. A document that is longer
    than a block starts one and is not cut; block numbers that it covers stay in the schedule as
    its slots. An empty table gives an empty result. The driver and one task hold one entry per source.
    """
    keep = keep or ["doc_id"]
    spark = docs.sparkSession
    importable(spark)
    held = [f"__k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(h) for c, h in zip(keep, held, strict=True)], F.col(source).alias("__source"), F.col(text).alias("__text"))
    cut = stored(blocks(rows, held, "__source", "__text", block_chars), "blocks")
    # one row per source, as in ``weights``
    sizes = {r["__s"]: r for r in cut.groupBy("__s").agg(F.sum("__n").alias("chars"), (F.max("__block") + 1).alias("blocks"), F.ceil(F.sum("__n") / block_chars).alias("whole")).collect()}
    n_blocks = {s: max(r["blocks"], r["whole"]) for s, r in sizes.items()}
    if weights is None:
        weights = {s: float(r["chars"]) ** TEMPERATURE for s, r in sizes.items()}
    if missing := set(sizes) - set(weights):
        raise ValueError(f"no target weight for {sorted(map(str, missing))[:5]}")
    share = exact_weights({s: w for s, w in weights.items() if s in sizes})
    # the deadline of the last block of the source that needs most
    slots = max((-(-n_blocks[s] * sum(share.values()) // share[s]) for s in sizes), default=0)
    plan = slot_table(spark, share, n_blocks, slots)
    out = cut.join(plan, F.col("__s").eqNullSafe(F.col("p_source")) & (F.col("__block") == F.col("p_block")))
    return out.select(*[F.col(h).alias(c) for c, h in zip(keep, held, strict=True)], F.col("__s").alias("source"), F.col("__block").alias("block"), F.col("p_slot").alias("slot"), F.col("p_epoch").alias("epoch"), F.col("__at").alias("place"))
