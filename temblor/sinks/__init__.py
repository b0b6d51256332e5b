from temblor.sinks.batch import write_jdbc, write_kafka, write_table
from temblor.sinks.changelog import forget_covered, read_changelog, write_snapshot
from temblor.sinks.stream import (
    debug_console,
    file_batch_sink,
    jdbc_batch_sink,
    kafka_query,
)

__all__ = [
    "debug_console",
    "file_batch_sink",
    "forget_covered",
    "jdbc_batch_sink",
    "kafka_query",
    "read_changelog",
    "write_jdbc",
    "write_kafka",
    "write_snapshot",
    "write_table",
]
