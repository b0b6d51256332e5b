"""Sinks for micro-batches."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from temblor.config import JdbcTarget, KafkaTopic
from temblor.sinks.batch import json_values, write_jdbc

BatchSink = Callable[[DataFrame, int], None]


def jdbc_batch_sink(target: JdbcTarget, table: str) -> BatchSink:
    """Append each micro-batch with its `batch_id`.

    After a failure Spark may hand the same batch over again and JDBC offers no way to take rows
    back. The id tells repeated rows apart from new ones; `latest_view` is indifferent to them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(_with_batch_id(batch, batch_id), target, table, mode="append")

    return write


def file_batch_sink(path: str) -> BatchSink:
    """Write each micro-batch to its own partition; a batch handed over again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            _with_batch_id(batch, batch_id)
            .write.partitionBy("batch_id")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(path)
        )

    return write


def kafka_query(df: DataFrame, topic: KafkaTopic) -> DataStreamWriter:
    """Publish a stream as JSON messages without a key."""
    return json_values(df).writeStream.format("kafka").options(**topic.write_options())


def debug_console(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """Show a stream in full width, for debugging."""
    return df.writeStream.format("console").option("truncate", "false").outputMode(mode)


def _with_batch_id(batch: DataFrame, batch_id: int) -> DataFrame:
    return batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
