"""One callable per checked query: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables
from temblor import plans, streaming
from temblor.config import shared_dir
from temblor.operators import compacted, latest_view, proximity_join
from temblor.sinks import file_batch_sink, read_changelog, write_snapshot, write_table
from temblor.sources import (
    flatten_geojson,
    read_geojson_features,
    read_quakes_csv,
    read_table,
    read_text_stream,
    release_slices,
    replay_slices,
    stage_slices,
    write_slices,
)

Query = Callable[[SparkSession, str], DataFrame]

# The driver's events lie in 2024; the plans' defaults are other dates.
PERIOD = dict(start=datetime(2024, 1, 1), end=datetime(2024, 2, 1))
DAY = datetime(2024, 1, 2)
JOIN_SECONDS = 15 * 60
JOIN_BLOCK_ROWS = 64


def _batch(plan: Callable[..., DataFrame], table=tables.quakes, **parameters) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # `ts` and the untidied columns belong to the test table, not to the cleaned one.
        quakes = table(spark, sf_dir).drop("ts", "event_type", "raw_state")
        return plan(quakes, **parameters)

    return query


def _stream(build: Callable[[SparkSession, str], DataFrame], latest: bool, mode: str) -> Query:
    """Run a stream over all of `events` to its end, then read what it wrote."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        out = shared_dir(spark, "changelog")
        name = out.rsplit("/", 1)[1]
        streaming.start_changelog(
            df, file_batch_sink(out), name, shared_dir(spark, "stream"), mode
        ).awaitTermination()
        changelog = read_changelog(spark, out, df.schema)
        result = latest_view(changelog) if latest else changelog.drop("batch_id")
        return _without_zone(result)

    return query


def _windowed(window_plan: Callable[..., DataFrame]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        parsed = streaming.parse_quakes(tables.message_stream(spark, sf_dir))
        return window_plan(parsed, delay=tables.replay_delay(spark, sf_dir))

    return _stream(build, latest=True, mode="update")


def _all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.stream_all(streaming.parse_quakes(tables.message_stream(spark, sf_dir)))


def _joined_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (
        streaming.parse_quakes(tables.message_stream(spark, sf_dir)) for _ in range(2)
    )
    return streaming.stream_location_join(
        first, second, JOIN_SECONDS, tables.replay_delay(spark, sf_dir), block_rows=JOIN_BLOCK_ROWS
    )


def _joined_without_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs at a location from stored history: small batches, folded and restarted half-way."""
    inbox, history, out, checkpoint = (
        shared_dir(spark, x) for x in ("near", "history", "changelog", "stream")
    )
    sink = streaming.stored_join_sink(history, file_batch_sink(out))
    half = tables.PARTS // 2
    for parts in (range(half), range(half, tables.PARTS)):
        tables.write_near_messages(spark, sf_dir, inbox, parts)
        first, second = (
            streaming.parse_quakes(read_text_stream(spark, inbox, files_per_batch=1)) for _ in range(2)
        )
        both = streaming.both_sides(first, second)
        streaming.start_changelog(both, sink, out.rsplit("/", 1)[1], checkpoint, "append").awaitTermination()
        streaming.fold_history(spark, history)
    schema = streaming.stream_location_join(first, second).schema
    return _without_zone(read_changelog(spark, out, schema).drop("batch_id"))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts read through a snapshot of their changelog and the batches after it."""
    path, out = shared_dir(spark, "in-order"), shared_dir(spark, "changelog")
    tables.write_in_order(spark, sf_dir, path, late=False)
    parsed = streaming.parse_quakes(read_text_stream(spark, path, files_per_batch=1))
    counts = streaming.stream_count_gt3(parsed)
    name = out.rsplit("/", 1)[1]
    streaming.start_changelog(counts, file_batch_sink(out), name, shared_dir(spark, "stream")).awaitTermination()
    write_snapshot(spark, out, counts.schema, compacted)
    return _without_zone(latest_view(read_changelog(spark, out, counts.schema)))


def _late_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream with late rows: its windows, merged with the side table."""
    path, out = shared_dir(spark, "in-order"), shared_dir(spark, "late")
    tables.write_in_order(spark, sf_dir, path, late=True)
    parsed = streaming.parse_quakes(read_text_stream(spark, path, files_per_batch=1))
    delay = tables.part_delay(spark, sf_dir)
    both = streaming.with_late_rows(parsed, streaming.stream_count_gt3, "60 minutes", delay)
    streaming.start_changelog(
        both,
        streaming.late_rows_sink(out, delay),
        out.rsplit("/", 1)[1],
        shared_dir(spark, "stream"),
        more=streaming.LATE_SETTINGS,
    ).awaitTermination()
    merged = streaming.with_late_merged(
        spark, out, both.schema, streaming.stream_count_gt3, "60 minutes", num_quakes_mag_gt3=F.sum
    )
    return _without_zone(merged)


def _proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.quakes(spark, sf_dir).select("event_id", "date", "latitude", "longitude")
    return proximity_join(events, events).select("event_id_left", "event_id_right")


def _proximity_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.float_quakes(spark, sf_dir)
    return proximity_join(events, events).select("event_id_left", "event_id_right")


def _in_order(late: bool) -> Query:
    """Windows over files that come in order of time, a file per batch.

    The watermark lies a part of the table's span back, so that windows are closed on the way.
    """

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_dir(spark, "in-order")
        tables.write_in_order(spark, sf_dir, path, late)
        delay = tables.part_delay(spark, sf_dir)
        parsed = streaming.parse_quakes(read_text_stream(spark, path, files_per_batch=1))
        return streaming.stream_count_gt3(parsed, delay=delay)

    return _stream(build, latest=True, mode="update")


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON documents, flattened, sliced and published as files, then read as a stream."""
    path = shared_dir(spark, "published")
    write_slices(replay_slices(_flattened(spark, sf_dir), 300, column="time"), path)
    parsed = streaming.parse_quakes(read_text_stream(spark, path))
    return streaming.stream_equator_max(parsed, delay=tables.replay_delay(spark, sf_dir))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "raw-csv")
    raw = tables.raw_quakes(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    raw.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return _without_zone(plans.preprocess_quakes(read_quakes_csv(spark, path)))


def _table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "table")
    name = "quakes_" + path.rsplit("-", 1)[1]
    write_table(plans.preprocess_quakes(tables.raw_quakes(spark, sf_dir)), name, path)
    return read_table(spark, name)


def _flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_geojson(tables.documents(spark, sf_dir))


def _flattened_from_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as text files that are cut where a feature opens."""
    path = shared_dir(spark, "geojson")
    tables.documents(spark, sf_dir).write.text(path)
    return read_geojson_features(spark, path)


def _sql_over_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a catalog table; a closing semicolon is accepted."""
    path = shared_dir(spark, "table")
    name = "quakes_" + path.rsplit("-", 1)[1]
    write_table(plans.preprocess_quakes(tables.raw_quakes(spark, sf_dir)), name, path)
    return spark.sql(
        f"SELECT state, COUNT(*) AS total_occurrences, AVG(magnitude) AS average_magnitude "
        f"FROM {name} WHERE tsunami <> 0 AND state IS NOT NULL GROUP BY state;"
    )


def _released(window_plan: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Slices of five hours released in order of time, a file per batch, read as a stream.

    The watermark lies two slices back, however long the history is.
    """

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_dir(spark, "slices")
        sliced = replay_slices(tables.message_fields(spark, sf_dir), 300, column="moment")
        stage_slices(sliced, path, 120)
        release_slices(spark, path)
        parsed = streaming.parse_quakes(read_text_stream(spark, path, files_per_batch=1))
        return window_plan(parsed, delay="10 hours")

    return build


def _sliced(minutes: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = tables.quakes(spark, sf_dir).select("event_id", "date")
        return replay_slices(events, minutes, datetime(2024, 1, 1)).select("event_id", "slice_id")

    return query


def _without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the driver's tables have them. The session zone is UTC."""
    return df.select(
        [
            F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema
        ]
    )


QUERIES: dict[str, Query] = {
    "preprocess_quakes": lambda spark, sf_dir: plans.preprocess_quakes(
        tables.raw_quakes(spark, sf_dir)
    ),
    "tsunami_by_significance": _batch(plans.tsunami_by_significance),
    "average_magnitude": _batch(plans.average_magnitude),
    "state_frequency": _batch(plans.state_frequency),
    "depth_running": _batch(plans.depth_running),
    "depth_per_state": _batch(plans.depth_per_state),
    "ratio_gt3_per_state": _batch(plans.ratio_gt3_per_state),
    "yearly_tsunami_share": _batch(plans.yearly_tsunami_share),
    "hemisphere_monthly": _batch(plans.hemisphere_monthly),
    "event_pairs": _batch(plans.event_pairs, **PERIOD),
    "equator_monthly_average": _batch(plans.equator_monthly_average),
    "events_on_day": _batch(plans.events_on_day, day=DAY),
    "largest_aftershock": _batch(plans.largest_aftershock),
    "foreshock_pairs": _batch(plans.foreshock_pairs),
    "largest_foreshock": _batch(plans.largest_foreshock),
    "event_pairs_stored_date": _batch(plans.event_pairs, tables.quakes_by_ts, **PERIOD),
    "events_on_stored_day": _batch(plans.events_on_day, tables.quakes_by_ts, day=DAY),
    "proximity_join": _proximity,
    "proximity_join_float": _proximity_float,
    "read_quakes_csv": _csv_roundtrip,
    "read_table": _table_roundtrip,
    "sql_over_table": _sql_over_table,
    "flatten_geojson": _flattened,
    "read_geojson_features": _flattened_from_pieces,
    "replay_slices_15": _sliced(15),
    "replay_slices_300": _sliced(300),
    "parse_quakes": lambda spark, sf_dir: _without_zone(
        streaming.parse_quakes(tables.messages(spark, sf_dir))
    ),
    "stream_all": _stream(_all_messages, latest=False, mode="append"),
    "stream_avg_magnitude": _windowed(streaming.stream_avg_magnitude),
    "stream_count_gt3": _windowed(streaming.stream_count_gt3),
    "stream_count_gt3_in_order": _in_order(late=False),
    "stream_count_gt3_late": _in_order(late=True),
    "stream_published_slices": _stream(_published, latest=True, mode="update"),
    "stream_equator_max": _windowed(streaming.stream_equator_max),
    "stream_equator_count_gt4": _windowed(streaming.stream_equator_count_gt4),
    "stream_replayed_slices": _stream(
        _released(streaming.stream_equator_max), latest=True, mode="update"
    ),
    "stream_count_gt3_closed": _stream(
        _released(streaming.stream_count_gt3), latest=False, mode="append"
    ),
    "stream_location_join": _stream(_joined_streams, latest=False, mode="append"),
    "stream_location_join_unbounded": _joined_without_bound,
    "stream_count_gt3_compacted": _compacted,
    "stream_count_gt3_late_merged": _late_merged,
}


def in_utc(query: Query) -> Query:
    """Dates, windows and the oracle all assume a UTC session."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run
