"""Per-visit campaign summary as an incremental Structured Streaming job.

The batch key ``web_visit_campaigns`` summarises every visit (a user's events of one
day): start, page views, cart adds, purchase flag, ad impressions and clicks, and the
campaign running at the visit's start. Here the same summary is produced as events
arrive: a watermark on the event time bounds the state, each visit is a one-day
tumbling window per user, and a visit is emitted (append mode) once the watermark has
passed the end of its day. The campaign lookup is a stream-static join against the
fixed campaign table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.functions.exact import int_div
from tallyspark.sources import dims

EVENTS_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
                 "value double, props string")


def visit_summary(events: DataFrame, campaigns: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Streaming (or batch) per-visit summary of raw ``events`` rows."""
    e = events.select(F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_type")
    et = F.col("event_type")
    visits = (e.withWatermark("event_time", lateness)
              .groupBy("user_id", F.window("event_time", "1 day").alias("day"))
              .agg(F.min("event_time").alias("visit_start_time"),
                   F.count_if(et == "view").alias("page_views"),
                   F.count_if(et == "click").alias("cart_adds"),
                   F.max((et == "purchase").cast("int")).cast("bigint").alias("purchase"),
                   F.count_if(et == "signup").alias("impression"),
                   F.count_if(et == "error").alias("click")))
    v = visits.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("day.start").cast("string")).alias("visit_id"),
        "user_id",
        F.col("visit_start_time").cast("timestamp_ntz").alias("visit_start_time"),
        "page_views", "cart_adds", "purchase", "impression", "click")
    # a campaign becomes its days, so that the lookup is an equi-join whatever its size
    c = campaigns.select("campaign_name", F.col("start_date").alias("__cs"), F.col("end_date").alias("__ce"),
                         F.explode(F.sequence(F.to_date("start_date"), F.to_date("end_date"))).alias("__day"))
    j = v.join(c, (F.to_date(v["visit_start_time"]) == c["__day"]) & (v["visit_start_time"] >= c["__cs"])
               & (v["visit_start_time"] <= c["__ce"]), "left")
    # events.user_id is the cookie; three cookies make one user (as in the batch view)
    return j.select(int_div("user_id", F.lit(3)).alias("user_id"), "visit_id", "visit_start_time",
                    "page_views", "cart_adds", "purchase", "campaign_name", "impression", "click")


def start_visit_summary(spark: SparkSession, events_path: str, out_path: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """Run :func:`visit_summary` over the parquet files at ``events_path`` into parquet at
    ``out_path`` (append mode; state and progress under ``checkpoint_path``)."""
    src = spark.readStream.schema(EVENTS_SCHEMA).parquet(events_path)
    out = visit_summary(src, dims.campaigns(spark))
    w = (out.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
