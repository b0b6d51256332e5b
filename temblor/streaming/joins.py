"""Joining two streams."""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, TimestampType

from temblor.operators.skew import TILES, tile_hot_keys
from temblor.sinks.changelog import batch_ids, has_rows, read_changelog, write_snapshot
from temblor.sinks.stream import BatchSink

HISTORY_BUCKETS = 16

# Rows that a task gathers to pack them into blocks.
PACK_ROWS = 500_000


def stream_location_join(
    a: DataFrame,
    b: DataFrame,
    bound_seconds: int | None = None,
    delay: str | None = None,
    strips: int = 1,
    busy: Sequence[str] | None = None,
    block_rows: int = 1,
) -> DataFrame:
    """Events of two streams reported at the same location; a NULL location matches nothing.

    Matches lie at most `bound_seconds` apart. The bound, with `delay`, is what lets Spark forget
    old rows, and it also splits a busy location: the join key is the location and a time bucket at least
    twice as wide as the bound, so that a row of the first stream looks in one or two buckets and
    a row of the second is in one.

    A location that is busy within one bucket is cut further into `strips` x `strips` keys: a row
    has a strip of its own, by its hash, and a copy for each strip of the other side, so that every pair meets
    under one key. That costs `strips` times the state, for the `busy` locations alone if they are
    named. To fill the state partitions evenly, choose strips x strips well above their number
    (16 times); like it, both hold for the life of a checkpoint.

    With `block_rows` above 1, the rows that a batch brings for a key are packed into blocks of up to that
    many, neighbours in time, which cost a shuffle more. State is then looked up and written by the block, not by
    the row and pair, and blocks that meet are expanded to their pairs. A block is late, and forgotten, by
    its latest row: no row goes earlier than it would alone, and a late one may be met with its block. The times
    that come out carry no watermark. The number holds for the life of a checkpoint.

    With `bound_seconds=None`, by default, all pairs at a location match, whatever their times;
    Spark then keeps every row ever seen, as it does without a `delay`. `stored_join_sink` does the
    same without that state. Streams parsed with an origin give `origin1` and `origin2` as well.
    """
    first, second = _numbered(a, 1), _numbered(b, 2)
    columns = ["location", *first.columns[1:], *second.columns[1:]]
    if bound_seconds is None:
        first, second, cut = _cut_in_strips(first, second, strips, busy)
        return first.join(second, ["location", *cut]).select(*columns)

    # Moments are rounded down to seconds here, hence the extra second.
    reach = bound_seconds + 1
    low, high = (_bucket(F.unix_timestamp("time1") + shift, reach) for shift in (-reach, reach))
    if delay and block_rows == 1:
        first, second = first.withWatermark("time1", delay), second.withWatermark("time2", delay)
    first = first.select(
        "*",
        F.explode(F.when(low == high, F.array(low)).otherwise(F.array(low, high))).alias("bucket"),
    )
    second = second.withColumn("bucket", _bucket(F.unix_timestamp("time2"), reach))
    first, second, cut = _cut_in_strips(first, second, strips, busy)
    interval = F.expr(f"INTERVAL {int(bound_seconds)} SECONDS")
    near = (F.col("time2") >= F.col("time1") - interval) & (
        F.col("time2") <= F.col("time1") + interval
    )
    keys = ("location", "bucket", *cut)
    if block_rows > 1:
        first, second = _packed(first, keys, 1, block_rows), _packed(second, keys, 2, block_rows)
        if delay:
            first, second = first.withWatermark("last1", delay), second.withWatermark("last2", delay)
        near = _blocks_near(bound_seconds, reach)
    first, second = first.alias("f"), second.alias("s")
    same = near
    for key in keys:
        same = same & (F.col(f"f.{key}") == F.col(f"s.{key}"))
    joined = first.join(second, same)
    if block_rows > 1:
        joined = joined.select("f.location", F.inline("rows1"), "rows2").select("*", F.inline("rows2"))
        # Whole numbers: adding an interval asks the calendar of the zone, for every pair.
        apart = F.abs(F.unix_micros("time2") - F.unix_micros("time1"))
        return joined.where(apart <= bound_seconds * 1_000_000).select(*columns)
    return joined.select("f.location", *columns[1:])


def both_sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two streams of parsed messages as one, for `stored_join_sink`; `side` is 1 or 2."""
    columns = ["location", "magnitude", "time", *["origin"] * ("origin" in a.columns)]
    one, two = (df.select(*columns, F.lit(side).alias("side")) for df, side in ((a, 1), (b, 2)))
    return one.unionByName(two)


def stored_join_sink(
    history: str, sink: BatchSink, buckets: int = HISTORY_BUCKETS, hot_rows: int = 20_000
) -> BatchSink:
    """A sink for `both_sides` that hands on the pairs of equal location, whatever their times.

    What has been seen lies in the table `history`, not in a state store: it is as large as storage
    allows, and a batch reads only the parts of it that its own locations hash to. A pair comes out
    in the batch that brings its later row: new rows of one side meet the stored and the new ones of the other.

    A batch handed over again replaces what it had stored and meets earlier batches only, so it
    gives the same pairs; with a sink that replaces repeated batches no pair is repeated or lost.
    Rows at a location with more than `hot_rows` of them are joined in tiles. `fold_history` keeps
    the number of folders down; `buckets` holds for the life of the history.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = F.pmod(F.xxhash64("location"), F.lit(buckets)).cast("int")
        rows = batch.where("location IS NOT NULL").withColumn("bucket", place)
        own = f"{history}/batch_id={batch_id}"
        rows.hint("rebalance", "side", "bucket").write.partitionBy("side", "bucket").mode("overwrite").parquet(own)
        new = spark.read.schema(rows.schema).parquet(own)
        met = [r.bucket for r in new.select("bucket").distinct().collect()]
        old = read_changelog(spark, history, rows.schema, before=batch_id)
        old = old.where(F.col("bucket").isin(met)).select(*new.columns)
        # New rows look for rows of the other side; among themselves, the first side looks.
        sought = new.where("side = 2").unionByName(old)
        pairs = _meetings(
            new.withColumn("looking", F.col("side")), sought.selectExpr("*", "3 - side AS looking"), hot_rows
        )
        sink(pairs, batch_id)

    return write


def _meetings(new: DataFrame, sought: DataFrame, hot_rows: int) -> DataFrame:
    """Pairs of `new` and `sought` rows in the order of their sides; `looking` is the new row's side."""
    carried = [c for c in ("magnitude", "time", "origin") if c in new.columns]
    own, other = (
        df.select("location", "looking", *[F.col(c).alias(f"{kind}_{c}") for c in carried])
        for kind, df in (("own", new), ("other", sought))
    )
    own, other = tile_hot_keys(own, other, ["location", "looking"], hot_rows)
    met = own.join(other, ["location", "looking", *TILES])
    in_order = [
        F.when(F.col("looking") == side, F.col(f"own_{c}")).otherwise(F.col(f"other_{c}")).alias(f"{c}{side}")
        for side in (1, 2)
        for c in carried
    ]
    return met.select("location", *in_order)


def fold_history(spark, history: str) -> int | None:
    """Gather the stored batches of a `stored_join_sink` into one table with a folder per bucket."""
    ids = [k for k in batch_ids(spark, history) if has_rows(spark, f"{history}/batch_id={k}")]
    if not ids:
        return None
    schema = spark.read.parquet(f"{history}/batch_id={ids[-1]}").schema
    gathered = lambda rows: rows.hint("rebalance", "side", "bucket")
    return write_snapshot(spark, history, schema, gathered, partition_by=("side", "bucket"))


STRIPS = ("strip1", "strip2")


def _numbered(df: DataFrame, side: int) -> DataFrame:
    carried = ["magnitude", "time", *["origin"] * ("origin" in df.columns)]
    return df.select("location", *[F.col(name).alias(f"{name}{side}") for name in carried])


def _cut_in_strips(
    first: DataFrame, second: DataFrame, strips: int, busy: Sequence[str] | None
) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    """Two more join columns: a row's own strip, and one copy for each strip of the other side."""
    if strips == 1:
        return first, second, ()
    number = F.lit(int(strips))
    if busy is not None:
        number = F.when(F.col("location").isin(list(busy)), number).otherwise(1)
    own, copies = F.pmod(F.xxhash64(F.struct("*")), number), F.explode(F.sequence(F.lit(0), number - 1))
    return (
        first.select("*", own.alias(STRIPS[0])).select("*", copies.alias(STRIPS[1])),
        second.select("*", own.alias(STRIPS[1])).select("*", copies.alias(STRIPS[0])),
        STRIPS,
    )


def _blocks_near(bound_seconds: int, reach: int) -> Column:
    """Whether blocks may hold rows within the bound, and what tells Spark how long to keep them.

    A key's rows span less than four reaches, so the last times of blocks that meet lie within five;
    two hours are for zones, whose days are not equally long.
    """
    bound, kept = bound_seconds * 1_000_000, F.expr(f"INTERVAL {5 * reach + 7200} SECONDS")
    first1, last1, first2, last2 = (F.unix_micros(c) for c in ("first1", "last1", "first2", "last2"))
    near = (last2 >= first1 - bound) & (first2 <= last1 + bound)
    return near & (F.col("last2") >= F.col("last1") - kept) & (F.col("last2") <= F.col("last1") + kept)


def _packed(df: DataFrame, keys: Sequence[str], side: int, block_rows: int) -> DataFrame:
    """Rows of equal `keys` as blocks: `rows` in order of time, and the `first` and `last` of their times.

    Rows are dealt out by key first, so that blocks fill however the input is laid out. A task
    packs `PACK_ROWS` of them at a time and remembers nothing between batches.
    """
    time = f"time{side}"
    carried = [f for f in df.schema if f.name not in keys]
    rows = ArrayType(StructType(carried), False)
    moments = [StructField(f"{name}{side}", TimestampType()) for name in ("first", "last")]
    schema = StructType([*[df.schema[k] for k in keys], *moments, StructField(f"rows{side}", rows)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, PACK_ROWS):
            codes = [table[k].combine_chunks().dictionary_encode().indices.to_numpy() for k in keys]
            order = np.lexsort((table[time].cast(pa.int64()).to_numpy(), *codes))
            # A block ends where a key changes and after `block_rows` rows of a key.
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[order][1:] != c[order][:-1] for c in codes], axis=0)
            begins = np.flatnonzero(new)
            place = np.arange(len(order)) - np.repeat(begins, np.diff([*begins, len(order)]))
            begins = np.flatnonzero(place % block_rows == 0)
            ends = np.append(begins[1:], len(order))
            table = table.take(order).combine_chunks()
            column = lambda name: table[name].combine_chunks()
            members = pa.StructArray.from_arrays([column(f.name) for f in carried], [f.name for f in carried])
            offsets = pa.array(np.append(begins, len(order)).astype(np.int32))
            blocks = [column(k).take(begins) for k in keys]
            blocks += [column(time).take(begins), column(time).take(ends - 1)]
            blocks.append(pa.ListArray.from_arrays(offsets, members))
            yield from pa.Table.from_arrays(blocks, names=schema.names).to_batches(max_chunksize=10_000)

    whole = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return whole.repartition(*keys).mapInArrow(pack, schema)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to tables of at least so many rows, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _bucket(seconds, reach: int):
    return F.floor(seconds / (2 * reach))
