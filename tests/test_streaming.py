"""Streams over text files, one micro-batch per file."""

from __future__ import annotations

import json
import os
import random
import re
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.operators import drop_repeats, latest_view
from temblor.sinks import debug_console, file_batch_sink, read_changelog
from temblor.sources import read_text_stream
from temblor.streaming import (
    parse_quakes,
    start_changelog,
    stream_all,
    stream_avg_magnitude,
    stream_count_gt3,
    stream_equator_count_gt4,
    stream_equator_max,
    stream_location_join,
)
from temblor.streaming.joins import _bucket
from tests.conftest import plan_text, rows

HOUR = 3_600_000
MIDNIGHT = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def message(time: int | None, **more) -> str:
    fields = dict(
        longitude=1.0, latitude=1.0, depth=1.0, location="X", magnitude=5.0, time=time,
        tsunami=0, status="reviewed",
    )
    return json.dumps(fields | more)


class Inbox:
    """A folder of message files; files are taken in the order they were added."""

    def __init__(self, spark):
        self.spark = spark
        self.path = shared_dir(spark, "inbox")
        os.makedirs(self.path)
        self.count = 0

    def add(self, *lines: str) -> None:
        file = Path(self.path, f"{self.count:03d}.txt")
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.count * 10,) * 2)
        self.count += 1

    def stream(self):
        return parse_quakes(read_text_stream(self.spark, self.path, files_per_batch=1))

    def table(self):
        return parse_quakes(self.spark.read.text(self.path))


@pytest.fixture
def inbox(spark):
    return Inbox(spark)


class Result:
    """A changelog and the checkpoint that belongs to it."""

    def __init__(self, spark):
        self.spark = spark
        self.path, self.checkpoint = shared_dir(spark, "log"), shared_dir(spark, "state")

    def take(self, df, mode: str = "update"):
        name = self.path.rsplit("/", 1)[1]
        start_changelog(df, file_batch_sink(self.path), name, self.checkpoint, mode).awaitTermination()
        return read_changelog(self.spark, self.path, df.schema)


@pytest.fixture
def result(spark):
    return Result(spark)


def _random_messages(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    lines = [
        message(
            rng.choice([None] + [MIDNIGHT + rng.randrange(0, 30 * HOUR)] * 20),
            latitude=rng.choice([None, rng.randrange(-80, 80) / 8]),
            magnitude=rng.choice([None, rng.randrange(0, 72) / 8]),
            location=rng.choice(["A", "A", "B", None]),
        )
        for _ in range(n)
    ]
    return [*lines, "{not json", ""]


def test_parse_reads_milliseconds_and_keeps_malformed_messages(spark):
    raw = spark.createDataFrame(
        [(bytearray(message(MIDNIGHT + 123, tsunami=1).encode()),), (bytearray(b"{oops"),), (None,)],
        "value BINARY",
    )
    parsed = parse_quakes(raw)
    assert parsed.dtypes[5:7] == [("time", "timestamp"), ("tsunami", "string")]
    moment = parsed.select(F.unix_millis("time"), "tsunami")
    assert rows(moment) == [(MIDNIGHT + 123, "1"), (None, None), (None, None)]


@pytest.mark.parametrize(
    "window",
    [stream_avg_magnitude, stream_count_gt3, stream_equator_max, stream_equator_count_gt4],
)
def test_windows_over_micro_batches_equal_the_batch_query(inbox, result, window):
    for seed in range(4):
        inbox.add(*_random_messages(seed, 60))
    changelog = result.take(window(inbox.stream(), delay="40 hours"))
    assert changelog.select("batch_id").distinct().count() > 1
    latest = latest_view(changelog)
    assert changelog.count() > latest.count()
    assert rows(latest) == rows(window(inbox.table()))


def test_window_columns_and_alignment(inbox):
    inbox.add(message(MIDNIGHT + HOUR, magnitude=4.5), message(MIDNIGHT + HOUR, magnitude=4.0))
    utc = timezone.utc

    def at(window) -> tuple:
        df = window(inbox.table())
        r = df.select(F.unix_millis("start"), F.unix_millis("end"), df.columns[2]).first()
        return df.columns[2], (r[0] - MIDNIGHT) / HOUR, (r[1] - MIDNIGHT) / HOUR, r[2]

    assert datetime.fromtimestamp(MIDNIGHT / 1000, utc) == datetime(2024, 1, 1, tzinfo=utc)
    assert at(stream_avg_magnitude) == ("avg_magnitude", 1.0, 1.5, 4.25)
    assert at(stream_count_gt3) == ("num_quakes_mag_gt3", 1.0, 2.0, 2)
    # Five hours do not divide a day: windows count from the epoch, not from midnight.
    assert at(stream_equator_max) == ("max_magnitude", -2.0, 3.0, 4.5)
    assert at(stream_equator_count_gt4)[3] == 1


def test_rows_beyond_the_watermark_are_dropped_and_others_are_not(inbox, result):
    # A batch is held against the watermark that was known before the one preceding it.
    inbox.add(message(MIDNIGHT + 10 * HOUR))
    inbox.add(message(MIDNIGHT + 10 * HOUR))
    inbox.add(message(MIDNIGHT + 5 * HOUR), message(MIDNIGHT + 9 * HOUR))
    latest = latest_view(result.take(stream_count_gt3(inbox.stream(), delay="2 hours")))
    hours = rows(latest.select(((F.unix_millis("start") - MIDNIGHT) / HOUR).cast("int")))
    assert hours == [(10,), (9,)]


def test_a_restart_goes_on_where_the_checkpoint_ends(inbox, result):
    inbox.add(message(MIDNIGHT), message(MIDNIGHT + 1))
    plan = lambda: stream_count_gt3(inbox.stream(), delay="40 hours")
    assert rows(latest_view(result.take(plan())).select("num_quakes_mag_gt3")) == [(2,)]
    inbox.add(message(MIDNIGHT + 2))
    changelog = result.take(plan())
    assert rows(latest_view(changelog).select("num_quakes_mag_gt3")) == [(3,)]
    assert rows(changelog.select("num_quakes_mag_gt3")) == [(2,), (3,)]
    assert result.take(plan()).count() == 2


def test_stream_all_stores_every_message_once(inbox, result):
    inbox.add(message(MIDNIGHT), "{oops", message(None))
    inbox.add(message(MIDNIGHT))
    stored = result.take(stream_all(inbox.stream()), mode="append").drop("batch_id")
    assert stored.columns == inbox.table().columns
    assert rows(stored) == rows(inbox.table())


def test_a_batch_handed_over_twice_replaces_itself(spark, folder):
    sink = file_batch_sink(folder)
    df = spark.range(3)
    for batch_id in (0, 1, 1, 0):
        sink(df, batch_id)
    stored = read_changelog(spark, folder, df.schema)
    assert rows(stored.groupBy("batch_id").count()) == [(0, 3), (1, 3)]


def _plain_join(a, b, bound: int | None):
    near = "true" if bound is None else (
        f"f.time BETWEEN s.time - INTERVAL {bound} SECONDS AND s.time + INTERVAL {bound} SECONDS"
    )
    return a.alias("f").join(b.alias("s"), F.expr(f"f.location = s.location AND {near}")).selectExpr(
        "f.location", "f.magnitude", "f.time", "s.magnitude", "s.time"
    )


@pytest.mark.parametrize("bound", [1, 900, 18_000, None])
def test_location_join_over_micro_batches_equals_the_batch_join(spark, result, bound):
    first, second = Inbox(spark), Inbox(spark)
    for seed in range(3):
        first.add(*_random_messages(seed, 50))
        second.add(*_random_messages(seed + 50, 50))
    # Exactly on the bound, to the millisecond, and one beyond it.
    first.add(message(MIDNIGHT + 7, location="edge"))
    for gap in (bound or 1, -(bound or 1)):
        second.add(
            message(MIDNIGHT + 7 + gap * 1000, location="edge", magnitude=1.0),
            message(MIDNIGHT + 7 + gap * 1000 + (1 if gap > 0 else -1), location="edge"),
        )
    joined = stream_location_join(first.stream(), second.stream(), bound, "40 hours")
    stored = result.take(joined, mode="append").drop("batch_id")
    assert stored.columns == ["location", "magnitude1", "time1", "magnitude2", "time2"]
    expected = rows(_plain_join(first.table(), second.table(), bound))
    assert rows(stored) == expected
    assert sum(r[0] == "edge" for r in expected) == (4 if bound is None else 2)


def test_kafka_rows_keep_their_origin(spark):
    raw = spark.createDataFrame(
        [("t", 0, 7, message(MIDNIGHT)), ("t", 1, 7, message(MIDNIGHT)), ("t", 1, 7, message(MIDNIGHT))],
        "topic STRING, partition INT, offset BIGINT, value STRING",
    )
    parsed = parse_quakes(raw, with_origin=True)
    stored = stream_all(parsed)
    assert rows(drop_repeats(stored).select("origin")) == [("t/0/7",), ("t/1/7",)]
    joined = stream_location_join(parsed, parsed, 900)
    assert joined.columns == [
        "location", "magnitude1", "time1", "origin1", "magnitude2", "time2", "origin2",
    ]
    assert joined.count() == 9
    assert drop_repeats(joined, ("origin1", "origin2")).count() == 4


def test_a_busy_location_is_spread_over_the_join_key(spark):
    """All rows at one location: the key still varies with time."""
    times = spark.range(0, 5000).select(
        F.lit("hot").alias("location"),
        F.lit(1.0).alias("magnitude"),
        F.timestamp_seconds(F.col("id") * 600).alias("time"),
    )
    joined = stream_location_join(times, times, 900)
    keys = times.select(_bucket(F.unix_timestamp("time"), 901).alias("bucket")).distinct()
    assert keys.count() > 1000
    assert re.search(r"Join \[.*bucket#", plan_text(joined, "simple"))
    assert joined.count() == 5000 * 3 - 2


def test_console_copies_run(inbox):
    inbox.add(message(MIDNIGHT))
    writer = debug_console(stream_avg_magnitude(inbox.stream()), "complete")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert "ConsoleTable" in query.lastProgress.sink.description
