"""Stored joins, snapshots of changelogs, and busy locations in the join's state."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from temblor import jobs
from temblor.config import shared_dir
from temblor.operators import compacted, latest_view
from temblor.sinks import file_batch_sink, forget_covered, read_changelog, write_snapshot
from temblor.sinks.changelog import batch_ids, newest_snapshot
from temblor.streaming import (
    both_sides,
    fold_history,
    start_changelog,
    stored_join_sink,
    stream_location_join,
)
from tests.conftest import rows

MESSAGE = "location string, magnitude double, time timestamp"
T0 = datetime(2024, 1, 1)


def _messages(spark, *values):
    return spark.createDataFrame([(place, m, T0 + timedelta(minutes=t)) for place, m, t in values], MESSAGE)


def _batches(spark):
    return [
        both_sides(_messages(spark, ("x", 1.0, 0), ("x", 1.0, 0), (None, 2.0, 0)), _messages(spark, ("x", 5.0, 900))),
        both_sides(_messages(spark, ("y", 2.0, 1)), _messages(spark, ("x", 6.0, -900), (None, 1.0, 0))),
        both_sides(_messages(spark), _messages(spark)),
        both_sides(_messages(spark, ("x", 3.0, 5)), _messages(spark, ("y", 7.0, 99999), ("z", 8.0, 0))),
    ]


def _joined_whole(batches):
    whole = batches[0]
    for batch in batches[1:]:
        whole = whole.unionByName(batch)
    first, second = (whole.where(F.col("side") == side).drop("side") for side in (1, 2))
    return stream_location_join(first, second)


@pytest.mark.parametrize("hot_rows", [20_000, 1])
def test_stored_join_gives_every_pair_once(spark, folder, hot_rows):
    batches, out = _batches(spark), shared_dir(spark, "pairs")
    sink = stored_join_sink(folder, file_batch_sink(out), buckets=3, hot_rows=hot_rows)
    whole = _joined_whole(batches)
    for k, batch in enumerate(batches):
        sink(batch, k)
        if k == 2:
            assert fold_history(spark, folder) == 1
        sink(batch, k)  # handed over again after a failure
    assert rows(read_changelog(spark, out, whole.schema).drop("batch_id")) == rows(whole)
    assert whole.count() == 7


def test_a_batch_reads_only_the_buckets_it_meets(spark, folder):
    seen = []
    sink = stored_join_sink(folder, lambda pairs, k: seen.append(pairs.inputFiles()), buckets=8)
    places = [f"place{k}" for k in range(40)]
    sink(both_sides(_messages(spark, *[(p, 1.0, 0) for p in places]), _messages(spark)), 0)
    sink(both_sides(_messages(spark), _messages(spark, ("place7", 2.0, 0))), 1)
    old = {f.split("bucket=")[1].split("/")[0] for f in seen[1] if "batch_id=0" in f}
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("place7")), F.lit(8))).first()[0]
    plan_filters = spark.read.parquet(folder).where(f"bucket = {bucket}").select("location").distinct()
    assert str(bucket) in old and 0 < plan_filters.count() < 40


def test_stored_join_of_streams_restarts_without_repeats(spark, folder):
    inbox, out, checkpoint = (shared_dir(spark, x) for x in ("inbox", "pairs", "checkpoint"))
    sink = stored_join_sink(folder, file_batch_sink(out))
    for _ in range(2):
        for k in range(3):
            _messages(spark, *[(f"p{j % 4}", float(k), j) for j in range(8)]).coalesce(1).write.mode("append").parquet(inbox)
        one, two = (spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(inbox) for _ in range(2))
        start_changelog(both_sides(one, two), sink, "restart", checkpoint, "append").awaitTermination()
    assert len(batch_ids(spark, folder)) >= 6
    table = spark.read.parquet(inbox)
    want = stream_location_join(table, table)
    assert rows(read_changelog(spark, out, want.schema).drop("batch_id")) == rows(want)
    assert want.count() == 6 * 2 * 6 * 2 * 4


COUNTS = "start long, end long, n long"


def _counts(spark, path, *batches):
    for k, batch in batches:
        file_batch_sink(path)(spark.createDataFrame(batch, COUNTS), k)


def test_snapshot_covers_finished_batches_and_readers_see_either_state(spark, folder):
    schema = spark.createDataFrame([], COUNTS).schema
    _counts(spark, folder, (0, [(0, 1, 5), (1, 2, 1)]), (1, [(0, 1, 7)]), (2, [(2, 3, 4)]))
    before = read_changelog(spark, folder, schema)  # a reader that is at work during the switch
    want = rows(latest_view(before))
    assert newest_snapshot(spark, folder) == (-1, None)
    assert write_snapshot(spark, folder, schema, compacted) == 1
    after = read_changelog(spark, folder, schema)
    assert rows(latest_view(before)) == rows(latest_view(after)) == want
    assert after.count() == 3 and before.count() == 4
    assert write_snapshot(spark, folder, schema, compacted) is None
    _counts(spark, folder, (2, [(2, 3, 4)]), (4, [(0, 1, 9), (5, 6, 1)]))  # 2 again; 3 had no rows
    assert write_snapshot(spark, folder, schema, compacted, upto=4) == 4
    assert rows(latest_view(read_changelog(spark, folder, schema))) == [(0, 1, 9), (1, 2, 1), (2, 3, 4), (5, 6, 1)]
    assert rows(latest_view(read_changelog(spark, folder, schema, before=2))) == [(0, 1, 7), (1, 2, 1)]


def test_half_written_snapshots_do_not_count(spark, folder):
    schema = spark.createDataFrame([], COUNTS).schema
    _counts(spark, folder, (0, [(0, 1, 5)]), (1, [(0, 1, 6)]))
    spark.createDataFrame([(9, 9, 9, 0)], COUNTS + ", batch_id long").write.parquet(f"{folder}/_snapshots/0-abandoned")
    assert rows(latest_view(read_changelog(spark, folder, schema))) == [(0, 1, 6)]


def test_compact_program_forgets_what_it_covers(spark, folder):
    schema = spark.createDataFrame([], COUNTS).schema
    _counts(spark, folder, *[(k, [(0, 1, k), (k, k + 1, 1)]) for k in range(5)])
    want = rows(latest_view(read_changelog(spark, folder, schema)))
    args = jobs._arguments().parse_args(["compact", "--changelog", folder, "--keys", "start", "end", "--forget"])
    assert jobs.compact(spark, args.changelog, tuple(args.keys), args.upto, args.forget) == 3
    assert batch_ids(spark, folder) == [4]
    assert rows(latest_view(read_changelog(spark, folder, schema))) == want
    assert forget_covered(spark, folder) == 0
    assert rows(read_changelog(spark, shared_dir(spark, "nothing"), schema)) == []


def _state_rows(spark, checkpoint, side):
    reader = spark.read.format("statestore").option("joinSide", side)
    return {r.partition_id: r["count"] for r in reader.load(checkpoint).groupBy("partition_id").count().collect()}


def test_busy_location_spreads_over_the_state(spark):
    inbox, few, out, checkpoint = (shared_dir(spark, x) for x in ("many", "few", "pairs", "checkpoint"))
    many = spark.range(100_000).selectExpr(
        "'busy' AS location", "CAST(id AS DOUBLE) AS magnitude", "timestamp_seconds(1704067200 + id % 1500) AS time"
    )
    many.coalesce(2).write.parquet(inbox)
    other = spark.range(12).selectExpr(
        "IF(id < 10, 'busy', 'calm') AS location", "CAST(id AS DOUBLE) AS magnitude", "timestamp_seconds(1704067200 + id * 100) AS time"
    )
    other.coalesce(1).write.parquet(few)
    first, second = (spark.readStream.schema(MESSAGE).parquet(p) for p in (inbox, few))
    joined = stream_location_join(first, second, 900, "2 hours", strips=12, busy=["busy"])
    start_changelog(joined, file_batch_sink(out), "busy", checkpoint, "append", state_partitions=4).awaitTermination()
    want = stream_location_join(many, other, 900)
    got = read_changelog(spark, out, want.schema).drop("batch_id")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    kept = [_state_rows(spark, checkpoint, side) for side in ("left", "right")]
    total = [sum(side.get(p, 0) for side in kept) for p in range(4)]
    assert sum(total) >= 100_000 and max(total) <= 2 * sum(total) / 4


@pytest.mark.parametrize("bound", [None, 900])
def test_strips_change_no_pair(spark, bound):
    a = _messages(spark, *[(f"p{k % 3}", float(k), k) for k in range(40)], (None, 1.0, 1))
    b = _messages(spark, *[(f"p{k % 4}", float(k), k + 7) for k in range(40)])
    want = rows(stream_location_join(a, b, bound))
    assert rows(stream_location_join(a, b, bound, strips=3)) == want
    assert rows(stream_location_join(a, b, bound, strips=3, busy=["p1"])) == want and want
