"""From messages to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.schemas import MESSAGE


def parse_quakes(raw: DataFrame, with_origin: bool = False) -> DataFrame:
    """The fields of the JSON message in `value`, with `time` as a timestamp.

    The wire format is epoch milliseconds. A malformed message becomes a row of NULLs: windows
    skip it (it has no time) and `stream_all` keeps it.

    `with_origin` adds where a Kafka message came from, as `origin`: topic/partition/offset. It
    identifies the message, also among equal ones (see `drop_repeats`).
    """
    columns = [F.from_json(F.col("value").cast("string"), MESSAGE).alias("data")]
    if with_origin:
        columns.append(F.concat_ws("/", "topic", "partition", "offset").alias("origin"))
    kept = ["data.*", *["origin"] * with_origin]
    return raw.select(*columns).select(*kept).withColumn("time", F.timestamp_millis("time"))
