"""Replaying history in time slices."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampType


def replay_slices(
    df: DataFrame, slice_minutes: int = 15, t0: datetime | None = None, column: str = "date"
) -> DataFrame:
    """Add `slice_id`, the number of the time slice since `t0` that an event belongs to.

    A slice includes its start and excludes its end. Events before `t0` belong to no slice and
    are left out, as are those without a time. `t0` defaults to the full hour (UTC) before the
    first event, which is looked up as part of the query. `column` is a timestamp, or a number of
    milliseconds since the epoch as messages have it.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, LongType):
        kind = TimestampType()
        second = F.floor(F.col(column) / 1000)
    else:
        second = F.unix_timestamp(column)
    if t0 is None:
        begin = df.agg(F.floor(F.min(second) / 3600) * 3600).scalar()
    else:
        begin = F.unix_timestamp(F.lit(t0.isoformat(sep=" ")).cast(kind))
    since = second - begin
    return df.withColumn("slice_id", F.floor(since / (slice_minutes * 60))).where("slice_id >= 0")


def write_slices(df: DataFrame, path: str) -> None:
    """Write rows with a `slice_id` as JSON messages, one folder per slice.

    A text file stream reads them back with `value` holding the message. The rebalance hint
    gathers a slice into few files and still splits a slice that is too large for one task.
    """
    fields = [c for c in df.columns if c != "slice_id"]
    messages = df.select(F.to_json(F.struct(*fields)).alias("value"), "slice_id")
    messages.hint("rebalance", "slice_id").write.partitionBy("slice_id").mode("overwrite").text(
        path
    )


def stage_slices(df: DataFrame, path: str, per_release: int = 96) -> None:
    """Write rows with a `slice_id` as JSON messages in order of time, not yet to be seen by readers.

    A release holds `per_release` slices, a day of 15-minute ones by default, in a folder of its own
    under `path/_staged`; its files follow each other in time. The rows are dealt out by ranges, so that a
    crowded slice is spread over several files and a quiet month takes no more tasks than its rows need.
    """
    fields = [c for c in df.columns if c != "slice_id"]
    message = F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("value")
    messages = df.select(message, "slice_id", F.floor(F.col("slice_id") / per_release).alias("release"))
    ranged = messages.repartitionByRange("slice_id", F.xxhash64("value")).sortWithinPartitions("slice_id")
    ranged.select("value", "release").write.partitionBy("release").text(f"{path}/_staged")


def release_slices(spark: SparkSession, path: str, most: int | None = None, pause: float = 0) -> list[int]:
    """Let readers see the next `most` staged releases, oldest first; the numbers of those released.

    A release appears as a whole, by one rename, and what is still staged is what is left to do, so
    that a run that was stopped is taken up by the next. Files get ascending times: a file stream
    takes them in that order and, with a limit of files per batch, reads history as it happened even if
    all of it lies there. `pause` is in seconds, between releases.
    """
    waiting = releases(spark, f"{path}/_staged")[:most]
    last = max((t for k in releases(spark, path)[-1:] for _, t in _files(spark, f"{path}/release={k}")), default=0)
    for number, release in enumerate(waiting):
        if number and pause:
            time.sleep(pause)
        last = max(last + 1, int(time.time() * 1000))
        staged, system = _hadoop(spark, f"{path}/_staged/release={release}")
        for file, _ in _files(spark, f"{path}/_staged/release={release}"):
            system.setTimes(file, last, -1)
            last += 1
        if not system.rename(staged, _hadoop(spark, f"{path}/release={release}")[0]):
            raise RuntimeError(f"release {release} could not be moved under {path}")
    return waiting


def releases(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the releases that lie in a folder, ascending."""
    folder, system = _hadoop(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("release="))


def _files(spark: SparkSession, path: str) -> list[tuple]:
    """Paths and times of a folder's files, in the order of their names."""
    folder, system = _hadoop(spark, path)
    found = [s for s in system.listStatus(folder) if not s.getPath().getName().startswith((".", "_"))]
    return [(s.getPath(), s.getModificationTime()) for s in sorted(found, key=lambda s: s.getPath().getName())]


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
