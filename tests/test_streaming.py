"""The streaming visit summary agrees with the batch key on every closed day."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyspark.streaming.visits import start_visit_summary

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch_for_closed_days(spark):
    work = tempfile.mkdtemp(prefix="tallyspark-stream-")
    src = os.path.join(work, "events")
    os.makedirs(src)
    shutil.copy(f"{SF}/events.parquet", os.path.join(src, "part-0.parquet"))
    q = start_visit_summary(spark, src, os.path.join(work, "out"), os.path.join(work, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(work, "out"))
    batch = E.queries()["web_visit_campaigns"](spark, SF)
    last_day = batch.agg(F.max(F.to_date("visit_start_time"))).first()[0]
    cols = ["user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase", "campaign_name",
            "impression", "click"]
    closed = batch.where(F.to_date("visit_start_time") < F.lit(last_day)).select(*cols)
    streamed = got.select(*cols)
    assert streamed.count() > 0
    assert closed.exceptAll(streamed).count() == 0
    assert streamed.exceptAll(batch.select(*cols)).count() == 0
