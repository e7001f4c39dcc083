"""Exact deduplication by stateful streaming (operator 3), in DataFrame functions only.

A narrow key table (digest of the normalised text, identifier, size, address of the row) is streamed
through a keyed aggregation whose state lies on disk (RocksDB) and never expires. The state of a
digest is the number of rows seen, and size, identifier and address (the content locator) of the row
that stays so far. Later rows may replace that row. The final state is read back with Spark's
state reader.

A digest alone doesn't prove equality: the normalised bytes of the rows of each digest are compared
in full, by their least and greatest value per digest, which Spark combines before the shuffle, so a
hot digest costs one text per task. Digests whose rows differ are grouped again by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACES, placed_rows, shared_path, stored

#: Files of the key table that one micro-batch takes.
FILES_PER_BATCH = 4096
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # many small stores must not reserve disk ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without blanks, tabs, newlines, vertical tabs, form feeds and carriage returns."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def absorb(stream: DataFrame, checkpoint: str) -> None:
    """Run a streaming frame of key rows into the state at ``checkpoint`` until it has no more
    rows. A later call with more files and the same checkpoint goes on from that state."""
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        best = F.min(F.struct((-F.col("size")).alias("size"), F.col("id").isNull().alias("no_id"), "id", "file", "row"))
        state = stream.groupBy("digest").agg(F.count("*").alias("n"), best.alias("best"))
        query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_of(spark, checkpoint: str) -> DataFrame:
    """The state at a checkpoint: ``digest``, ``n`` and ``best`` (size negated, id, file, row)."""
    state = spark.read.format("statestore").load(checkpoint)
    count, best = state.schema["value"].dataType.names
    return state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias("digest"), F.col("value")[count].alias("n"), F.col("value")[best].alias("best"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, placed: bool = False) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key column, ``__file`` and ``__row`` (its
    address), ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Of rows with equal normalised texts the one with the most code points in the original text
    stays, then the smallest key (null last), then the first address, so exactly one row of a
    group is kept even if keys repeat. A null text is an empty one; all blank texts are equal.
    Only the two columns are read, so other columns of any name don't matter. An empty table
    gives an empty result. ``digest`` maps the normalised text to a key; its collisions are found
    by the comparison of the full texts and change nothing.

    With ``placed``, ``docs`` has the addresses already (``__file`` and ``__row`` of `row_address`).
    """
    spark = docs.sparkSession
    rows = placed_rows(docs, F.col(key).alias("id"), F.col(text).alias("text"), placed=placed)
    plain = normalised(F.col("text"))
    path = shared_path(spark, "keys")
    rows.select(digest(plain).alias("digest"), "id", F.length(F.coalesce("text", F.lit(""))).alias("size"), F.col("__file").alias("file"), F.col("__row").alias("row")).write.parquet(path)
    keys = spark.read.parquet(path)
    checkpoint = shared_path(spark, "state")
    stream = spark.readStream.schema(keys.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    absorb(stream, checkpoint)
    state = stored(state_of(spark, checkpoint), "groups")

    texts = rows.select(digest(plain).alias("digest"), plain.alias("plain"))
    same = texts.groupBy("digest").agg(F.min("plain").alias("low"), F.max("plain").alias("high"))
    mixed = stored(same.where(F.col("low") != F.col("high")).select("digest"), "mixed")
    groups = state.select("digest", F.col("n").alias("group_size"), F.col("best.id").alias("keep_id"), F.col("best.file").alias("keep_file"), F.col("best.row").alias("keep_row"))
    kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    columns = [F.col("id").alias(key), F.col("file").alias("__file"), F.col("row").alias("__row"), "keep_id", "group_size", kept.alias("kept"), "digest"]
    if mixed.isEmpty():
        return keys.join(groups, "digest").select(*columns)
    # equal digests, different texts: these rows are grouped by the text itself
    apart = rows.withColumn("plain", plain).withColumn("digest", digest(plain)).join(mixed, "digest", "left_semi")
    apart = apart.select("digest", "plain", "id", F.length(F.coalesce("text", F.lit(""))).alias("size"), F.col("__file").alias("file"), F.col("__row").alias("row"))
    best = F.min(F.struct((-F.col("size")).alias("size"), F.col("id").isNull().alias("no_id"), "id", "file", "row"))
    by_text = apart.groupBy("digest", "plain").agg(F.count("*").alias("group_size"), best.alias("best"))
    by_text = by_text.select("digest", "plain", "group_size", F.col("best.id").alias("keep_id"), F.col("best.file").alias("keep_file"), F.col("best.row").alias("keep_row"))
    one = keys.join(mixed, "digest", "left_anti").join(groups, "digest").select(*columns)
    return one.unionByName(apart.join(by_text, ["digest", "plain"]).select(*columns))

