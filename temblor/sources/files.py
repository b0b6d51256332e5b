"""Bounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from temblor.schemas import RAW_CSV


def read_quakes_csv(
    spark: SparkSession, path: str, timestamp_format: str | None = None
) -> DataFrame:
    """Raw records from CSV files with a header line.

    Columns are taken by position and the header is only skipped. A field that does not parse
    becomes NULL and its row is kept.
    """
    reader = spark.read.schema(RAW_CSV).option("header", True).option("mode", "PERMISSIVE")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)
