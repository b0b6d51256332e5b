"""Unbounded sources of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from temblor.config import KafkaTopic


def read_quake_stream(
    spark: SparkSession, topic: KafkaTopic, max_offsets: int | None = None
) -> DataFrame:
    """Raw messages of one topic, from the latest offsets on unless `topic.extra` says otherwise.

    `max_offsets` bounds the size of a micro-batch, e.g. when catching up after a stop.
    """
    reader = spark.readStream.format("kafka").options(**topic.read_options())
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def read_text_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Raw messages from text files, one per line, in a `value` column like Kafka's."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
