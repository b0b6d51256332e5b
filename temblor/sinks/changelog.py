"""Tables that streams write batch by batch, and the snapshots that keep reading them cheap.

A changelog is a folder with a partition `batch_id` per micro-batch. Beside them, in folders that
Spark's readers pass over, lie snapshots and their manifests:

    batch_id=0/ batch_id=1/ ...
    _snapshots/<covered>-<unique>/     all batches up to number <covered>, folded
    _manifests/part-*.json             {"covered": ..., "folder": ...}, one file per snapshot

A snapshot counts from the moment its manifest appears, which is one file and comes into being by a
single rename; before, readers see the batches and the former snapshot, after, the new one and the batches later
than it. Nothing that a reader may still be reading is changed.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MANIFEST = "covered long, folder string"


def read_changelog(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """The stream's columns and `batch_id`: the newest snapshot and all batches after it.

    With `before`, only batches of a smaller number.
    """
    fields = StructType([*schema.fields, StructField("batch_id", LongType())])
    covered, folder = newest_snapshot(spark, path, before)
    later = [k for k in batch_ids(spark, path) if k > covered and (before is None or k < before)]
    rows = spark.createDataFrame([], fields)
    if later:
        # Folders are named, so that what a snapshot covers is not even listed.
        named = [f"{path}/batch_id={k}" for k in later]
        rows = spark.read.schema(fields).option("basePath", path).parquet(*named)
        rows = rows.select(*fields.names)
    if folder:
        kept = spark.read.schema(fields).parquet(f"{path}/_snapshots/{folder}")
        rows = kept.unionByName(rows) if later else kept
    return rows


def write_snapshot(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fold: Callable[[DataFrame], DataFrame],
    upto: int | None = None,
    partition_by: tuple[str, ...] = (),
) -> int | None:
    """Fold all batches up to number `upto` into a snapshot; the number, or None if there is nothing new.

    `fold` takes and returns rows with their `batch_id`. By default the newest batch is left out: a stream
    may be writing it, or write it again after a failure. An earlier batch is final as soon as a
    later one exists.
    """
    present = batch_ids(spark, path)
    if upto is None:
        upto = max(present, default=0) - 1
    covered, _ = newest_snapshot(spark, path)
    if not any(covered < k <= upto for k in present):
        return None
    folder = f"{upto}-{uuid.uuid4().hex}"
    rows = fold(read_changelog(spark, path, schema, before=upto + 1))
    rows.write.partitionBy(*partition_by).parquet(f"{path}/_snapshots/{folder}")
    manifest = spark.createDataFrame([(upto, folder)], MANIFEST).coalesce(1)
    manifest.write.mode("append").json(f"{path}/_manifests")
    return upto


def newest_snapshot(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, str | None]:
    """Number of the last batch covered, and the folder; (-1, None) without a snapshot."""
    manifests = f"{path}/_manifests"
    names = [n for n in _names(spark, manifests) if n.endswith(".json") and not n.startswith((".", "_"))]
    if not names:
        return -1, None
    rows = spark.read.schema(MANIFEST).json([f"{manifests}/{n}" for n in names])
    if before is not None:
        rows = rows.where(F.col("covered") < before)
    newest = rows.orderBy(F.desc("covered"), "folder").first()
    return tuple(newest) if newest else (-1, None)


def forget_covered(spark: SparkSession, path: str) -> int:
    """Remove the batches that the newest snapshot covers; how many there were.

    For when no reader that began before the snapshot is still at work.
    """
    covered, _ = newest_snapshot(spark, path)
    old = [k for k in batch_ids(spark, path) if k <= covered]
    for k in old:
        folder, system = _hadoop(spark, f"{path}/batch_id={k}")
        system.delete(folder, True)
    return len(old)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that lie in the changelog, ascending."""
    names = _names(spark, path)
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds more than its marks of success."""
    return any(not n.startswith((".", "_")) for n in _names(spark, path))


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, system = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]
