"""History released in order of time."""

from __future__ import annotations

from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.sinks import file_batch_sink, read_changelog
from temblor.sources import read_text_stream, release_slices, replay_slices, stage_slices
from temblor.sources.replay import releases
from temblor.streaming import parse_quakes, start_changelog, stream_count_gt3
from tests.conftest import rows


def _history(spark, n=4000):
    """Ten days, shuffled; a third of the rows within one quarter of an hour."""
    second = F.expr("1704067200 + IF(id % 3 = 0, 300000 + id % 600, id * 216)")
    return (
        spark.range(n)
        .select((second * 1000).alias("time"), F.lit(5.0).alias("magnitude"), F.col("id").alias("depth"))
        .repartition(5, F.xxhash64("depth"))
    )


def test_releases_are_bounded_and_hold_every_message_once(spark, folder):
    sliced = replay_slices(_history(spark), 15, column="time")
    stage_slices(sliced, folder, 96)
    assert releases(spark, folder) == [] and releases(spark, f"{folder}/_staged") == list(range(10))
    assert release_slices(spark, folder, most=4) == [0, 1, 2, 3]
    seen = spark.read.text(folder)
    assert sorted(r.release for r in seen.select("release").distinct().collect()) == [0, 1, 2, 3]
    assert release_slices(spark, folder) == [4, 5, 6, 7, 8, 9]
    assert release_slices(spark, folder) == []
    back = spark.read.text(folder).select(F.get_json_object("value", "$.depth").cast("long").alias("depth"))
    assert rows(back) == rows(_history(spark).select("depth"))


def test_files_follow_each_other_in_time(spark, folder):
    stage_slices(replay_slices(_history(spark), 15, column="time"), folder, 96)
    release_slices(spark, folder, most=3)
    release_slices(spark, folder)
    table = spark.read.text(folder).select(
        "_metadata.file_modification_time", F.get_json_object("value", "$.time").cast("long").alias("time")
    )
    spans = table.groupBy("file_modification_time").agg(F.min("time").alias("low"), F.max("time").alias("high"))
    spans = spans.orderBy("file_modification_time").collect()
    assert len(spans) >= 10
    slices = [(r.low // 900_000, r.high // 900_000) for r in spans]
    assert all(a[1] <= b[0] for a, b in zip(slices, slices[1:]))


def test_a_short_watermark_loses_nothing(spark, folder):
    history = _history(spark)
    stage_slices(replay_slices(history, 15, column="time"), folder, 96)
    release_slices(spark, folder)
    parsed = parse_quakes(read_text_stream(spark, folder, files_per_batch=1))
    counts, out = stream_count_gt3(parsed, delay="30 minutes"), shared_dir(spark, "changelog")
    start_changelog(counts, file_batch_sink(out), "replayed", shared_dir(spark, "c"), "append").awaitTermination()
    written = read_changelog(spark, out, counts.schema)
    assert written.select("batch_id").distinct().count() >= 8
    # Append mode: every window once, when it has closed; the last ones are still open.
    assert written.count() == written.select("start").distinct().count()
    whole = stream_count_gt3(parse_quakes(spark.read.text(folder)))
    closed = whole.where(F.col("end") <= F.lit(written.agg(F.max("end")).first()[0]))
    assert rows(written.drop("batch_id")) == rows(closed) and closed.count() > 200


def test_an_interrupted_release_is_taken_up(spark, folder):
    stage_slices(replay_slices(_history(spark, 300), 15, column="time"), folder, 96)
    before = releases(spark, f"{folder}/_staged")
    for _ in before:
        release_slices(spark, folder, most=1)
    assert releases(spark, folder) == before


def test_an_empty_history(spark, folder):
    stage_slices(replay_slices(_history(spark).where("false"), 15, column="time"), folder)
    assert release_slices(spark, folder) == []
