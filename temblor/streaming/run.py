"""Starting and watching streaming queries."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from temblor.config import STREAM_DEFAULTS, session_conf
from temblor.sinks.stream import BatchSink


def start_changelog(
    df: DataFrame,
    sink: BatchSink,
    name: str,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
    state_partitions: int | None = None,
    more: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Feed `df` to `sink`, batch by batch.

    With `every` (e.g. '60 seconds') the query runs on; without, it takes what is there and
    stops. `checkpoint` must be on shared storage and belong to this query alone. State is split
    into `state_partitions` parts, by default the session's shuffle partitions; the number holds
    for the life of the checkpoint, so choose it for the largest state expected. `more` are further
    settings of this query.
    """
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    settings = {**STREAM_DEFAULTS, **(more or {})}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if not every and mode == "update":
        # A closing batch without rows would only evict state, which the next run does as well. In
        # append mode it brings out the windows that have closed.
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    # A query takes these settings over when it starts.
    with session_conf(df.sparkSession, settings):
        return writer.trigger(**trigger).start()


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until all `queries` have ended; if one fails, stop the others and raise its error."""
    try:
        for query in _as_they_end(spark, queries):
            if query.exception():
                raise query.exception()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def _as_they_end(spark: SparkSession, queries: list[StreamingQuery]):
    pending = list(queries)
    while pending:
        ended = [q for q in pending if not q.isActive]
        for query in ended:
            pending.remove(query)
            yield query
        if not ended:
            # Returns when any query of the session ends, or after the timeout.
            spark.streams.awaitAnyTermination(5)
            spark.streams.resetTerminated()
