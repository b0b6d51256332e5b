"""The inbox of `stream_location_join_unbounded`: one file a write, however the table is stored."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from registry import tables


def test_near_messages_write_one_file_a_part(spark, folder):
    events = spark.range(0, 96).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("earthquake").alias("event_type"),
    )
    # A table of many files is read by as many tasks; before, each wrote a file and made a batch.
    events.repartition(8).write.parquet(f"{folder}/tables/events.parquet")
    inbox = f"{folder}/near"
    tables.write_near_messages(spark, f"{folder}/tables", inbox, range(tables.PARTS))
    assert len(glob.glob(f"{inbox}/part-*")) == tables.PARTS
    assert spark.read.text(inbox).count() == 96
