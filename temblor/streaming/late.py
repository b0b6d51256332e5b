"""Rows that come behind the watermark, kept instead of lost.

Spark drops a row of a windowed aggregate when its window has closed. Here the same query carries the rows
beside the windows, so that both are cut into the same batches, and the sink keeps those rows whose window
had closed in a side table. The windows and the side table together are the answer over all rows.

A plan's condition moves below its watermark, which then knows only the rows that meet it. The rows that
are carried along have a watermark over all of them, and the query has to go by the later of the two: start it
with SETTINGS.

    <path>/batch_id=0/kind=window/   what the batch changed in the windows
    <path>/batch_id=0/kind=late/     its late rows, as parsed, in `event`
    <path>/_metrics/batch_id=0/      rows, late rows and greatest time of the batch
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from temblor.operators.latest import latest_view
from temblor.sinks.stream import BatchSink

SETTINGS = {"spark.sql.streaming.multipleWatermarkPolicy": "max"}
WINDOW, LATE = "window", "late"
METRICS = "batch_id long, n_rows long, n_late long, max_millis long"


def with_late_rows(
    df: DataFrame, window_plan: Callable[..., DataFrame], window: str, delay: str
) -> DataFrame:
    """The rows of `window_plan` and those of `df` in one stream, for a `late_rows_sink`.

    The plan is given `window` and `delay`. Rows without a time belong to no window and are left out.
    """
    windows = window_plan(df, window=window, delay=delay)
    rows = df.withWatermark("time", delay).select(F.window("time", window)["end"].alias("end"), F.struct(*df.columns).alias("event"))
    return windows.withColumn("kind", F.lit(WINDOW)).unionByName(
        rows.withColumn("kind", F.lit(LATE)), allowMissingColumns=True
    )


def late_rows_sink(path: str, delay: str) -> BatchSink:
    """Write each batch of `with_late_rows` once, with its late rows and its metrics.

    A batch drops what had closed at the watermark that its predecessor ran with: the greatest
    time of all batches before that one, less the delay. It is taken from the metrics of those batches. A
    batch handed over again finds the same metrics and replaces what it had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation()
        is_row = F.col("kind") == LATE
        # Spark's watermark starts at 1970 and never lies before it.
        start, seen_until = F.timestamp_millis(F.lit(0).cast("long")), None
        if batch_id > 1:
            earlier = late_metrics(spark, path).where(F.col("batch_id") < batch_id - 1)
            seen_until = earlier.agg(F.max("max_millis")).first()[0]
        mark = F.timestamp_millis(F.lit(seen_until).cast("long")) - F.expr(f"INTERVAL {delay}")
        closed = F.col("end") <= F.greatest(mark, start)
        observed = batch.withColumn("closed", closed).observe(
            seen,
            F.count_if(is_row).alias("n_rows"),
            F.count_if(is_row & F.col("closed")).alias("n_late"),
            F.max(F.unix_millis(F.col("event")["time"])).alias("max_millis"),
        )
        kept = observed.where(~is_row | F.col("closed")).drop("closed")
        kept.write.partitionBy("kind").mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        found = seen.get
        values = [(batch_id, found["n_rows"], found["n_late"], found["max_millis"])]
        metrics = spark.createDataFrame(values, METRICS).coalesce(1)
        metrics.drop("batch_id").write.mode("overwrite").json(f"{path}/_metrics/batch_id={batch_id}")

    return write


def late_metrics(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, n_rows, n_late, max_millis: a row per batch."""
    metrics = f"{path}/_metrics"
    return spark.read.schema(METRICS).option("basePath", metrics).json(f"{metrics}/batch_id=*")


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The side table: late rows as `with_late_rows` was given them, and their batch."""
    return _kind(spark, path, schema, LATE).select("event.*", "batch_id")


def with_late_merged(
    spark: SparkSession,
    path: str,
    schema: StructType,
    window_plan: Callable[..., DataFrame],
    window: str,
    **combine: Callable[[Column], Column],
) -> DataFrame:
    """The windows' latest values, late rows included.

    `schema` is that of the stream; `combine` says for each value how two parts of a window make
    one, e.g. `F.sum` for a count or `F.max` for a maximum. A mean cannot be made from means: keep its sum and count.
    """
    values = list(combine)
    on_time = latest_view(_kind(spark, path, schema, WINDOW).select("start", "end", *values, "batch_id"))
    late = window_plan(late_rows(spark, path, schema), window=window)
    parts = on_time.unionByName(late)
    return parts.groupBy("start", "end").agg(*[how(F.col(c)).alias(c) for c, how in combine.items()])


def _kind(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    fields = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(fields).option("basePath", path).parquet(f"{path}/batch_id=*").where(F.col("kind") == kind)
