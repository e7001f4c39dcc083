"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the
columns of ``documents``, but for the last, which adds the ids. ``run`` writes each stage's result as
Parquet to the shared folder and reads it again as the next one's input.

In every stage: null in any column is kept as null; a null text counts as an empty one, a null language or source as
a value of its own or of the pool, as the operator says; very long texts are worked on whole; ties go to the smallest ``doc_id``,
and repeated rows are rows of their own; an empty table gives an empty table; and other columns of any name are carried along under
names of the stage's own, so none clashes with a column that the operators add.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, dedup, mixing, ngram, rules
from tallyspark.llm.common import row_address, rows_at, stored, table


#: The columns that operators read, by these names.
READ = ("doc_id", "text", "lang", "source")


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's result on ``docs`` with all other columns renamed, and its rows under the old names."""
    names = {c: c if c in READ else f"other_{i}" for i, c in enumerate(docs.columns)}
    out = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def _kept(docs: DataFrame, operator: Callable[..., DataFrame]) -> DataFrame:
    """The rows that the operator keeps; it and the join back see the same addresses."""

    def stage(docs: DataFrame) -> DataFrame:
        placed = row_address(docs)
        return rows_at(placed, operator(placed, placed=True).where("kept"))

    return _apart(docs, stage)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return _kept(docs, rules.quality_rules)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts one row stays."""
    return _kept(docs, dedup.exact_dedup)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; documents
    without words are in no group."""
    return _kept(docs, ngram.jaccard_groups)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture: every one at least once, those of sources that
    need more to reach their target weight again."""

    def stage(docs: DataFrame) -> DataFrame:
        placed = row_address(docs)
        slots = mixing.mix(placed, keep=["__file", "__row"])
        slots = stored(slots.select("__file", "__row", F.col("slot").alias("__slot"), F.col("place").alias("__place")), "slots")
        return placed.join(slots, ["__file", "__row"]).repartitionByRange("__slot", "__place").sortWithinPartitions("__slot", "__place")

    return _apart(docs, stage)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with the digests of ids and decoded bytes."""
    return bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_jaccard", near), ("mixing", mixed), ("bpe", encoded)]

#: The stages from the third on can't be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
