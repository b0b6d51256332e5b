"""Late rows of windowed streams: side table, metrics, merged answer."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.streaming import (
    LATE_SETTINGS,
    late_metrics,
    late_rows,
    late_rows_sink,
    parse_quakes,
    start_changelog,
    stream_count_gt3,
    stream_equator_max,
    with_late_merged,
    with_late_rows,
)
from tests.conftest import rows
from tests.test_streaming import HOUR, MIDNIGHT, Inbox, message

HOURLY = "60 minutes"


def _run(spark, df, path, checkpoint, delay="2 hours", plan=stream_count_gt3):
    both = with_late_rows(df, plan, HOURLY, delay)
    name = path.rsplit("/", 1)[1]
    start_changelog(both, late_rows_sink(path, delay), name, checkpoint, more=LATE_SETTINGS).awaitTermination()
    return both.schema


@pytest.mark.parametrize(
    "plan, name, how",
    [(stream_count_gt3, "num_quakes_mag_gt3", F.sum), (stream_equator_max, "max_magnitude", F.max)],
)
def test_windows_and_late_rows_make_the_batch_answer(spark, plan, name, how):
    rng, inbox = random.Random(7), Inbox(spark)
    for k in range(7):
        times = [MIDNIGHT + rng.randrange(max(0, 5 * k - 20), 5 * k + 5) * HOUR + rng.randrange(HOUR) for _ in range(40)]
        lines = [message(t, magnitude=rng.choice([None, 2.0, 3.5, 6.0])) for t in times]
        inbox.add(*lines, message(None), "{not json")
    path, checkpoint = shared_dir(spark, "late"), shared_dir(spark, "state")
    schema = _run(spark, inbox.stream(), path, checkpoint, plan=plan)
    merged = with_late_merged(spark, path, schema, plan, HOURLY, **{name: how})
    assert rows(merged) == rows(plan(inbox.table(), window=HOURLY))
    metrics = rows(late_metrics(spark, path).select("batch_id", "n_rows", "n_late"))
    assert [m[:2] for m in metrics] == [(k, 40) for k in range(7)]
    assert sum(m[2] for m in metrics) == late_rows(spark, path, schema).count() > 0


def test_a_restart_and_a_repeated_batch_change_nothing(spark):
    inbox = Inbox(spark)
    path, checkpoint = shared_dir(spark, "late"), shared_dir(spark, "state")
    hours = [[0, 9], [20], [1, 21], [2, 30], [3, 3, 31], [31]]
    for some in (hours[:3], hours[3:]):
        for batch in some:
            inbox.add(*[message(MIDNIGHT + h * HOUR) for h in batch])
        schema = _run(spark, inbox.stream(), path, checkpoint)

    def found():
        side = rows(late_rows(spark, path, schema).select("batch_id", F.unix_millis("time")))
        return side, rows(with_late_merged(spark, path, schema, stream_count_gt3, HOURLY, num_quakes_mag_gt3=F.sum))

    late, merged = found()
    assert late == [(k, MIDNIGHT + h * HOUR) for k, h in [(2, 1), (3, 2), (4, 3), (4, 3)]]
    assert merged == rows(stream_count_gt3(inbox.table()))
    # A batch that failed after its rows were written is handed over again, by its number.
    messages = spark.createDataFrame([(message(MIDNIGHT + h * HOUR),) for h in hours[4]], "value string")
    event = parse_quakes(messages)
    again = event.select(F.window("time", HOURLY)["end"].alias("end"), F.struct("*").alias("event"), F.lit("late").alias("kind"))
    windows = spark.read.parquet(f"{path}/batch_id=4/kind=window").drop("end", "event")
    kept = windows.withColumn("end", F.col("start") + F.expr("INTERVAL 1 HOUR")).withColumn("kind", F.lit("window"))
    copied = shared_dir(spark, "copy")
    kept.unionByName(again, allowMissingColumns=True).write.parquet(copied)
    late_rows_sink(path, "2 hours")(spark.read.schema(schema).parquet(copied), 4)
    assert found() == (late, merged)


def test_events_before_1970(spark):
    inbox = Inbox(spark)
    path, checkpoint = shared_dir(spark, "late"), shared_dir(spark, "state")
    for day in (-900, -800, -850, -700):
        inbox.add(message(day * 24 * HOUR))
    schema = _run(spark, inbox.stream(), path, checkpoint)
    merged = with_late_merged(spark, path, schema, stream_count_gt3, HOURLY, num_quakes_mag_gt3=F.sum)
    assert rows(merged) == rows(stream_count_gt3(inbox.table()))
