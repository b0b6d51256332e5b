"""Bounded sinks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.config import JdbcTarget, KafkaTopic


def write_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Replace a catalog table (parquet); with `path`, at that location."""
    writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite") -> None:
    """Write a relational table; by default drop and create it.

    The rows are dealt out to as many tasks as there may be connections. Leaving that to the
    writer would merge partitions without a shuffle, and the query's last stage would run in
    those few tasks as well.
    """
    dealt = df.repartition(target.max_connections)
    dealt.write.format("jdbc").options(**target.options(table)).mode(mode).save()


def write_kafka(df: DataFrame, topic: KafkaTopic) -> None:
    """Publish every row as one JSON message without a key."""
    json_values(df).write.format("kafka").options(**topic.write_options()).save()


def json_values(df: DataFrame) -> DataFrame:
    """Rows as JSON in a single `value` column; NULL fields are written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
