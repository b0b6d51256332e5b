"""The runnable programs: the batch report, the stream processor, and the publisher of history."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from temblor import plans, streaming
from temblor.config import (
    STREAM_DEFAULTS,
    JdbcTarget,
    KafkaTopic,
    build_session,
    session_conf,
)
from temblor.operators import compacted
from temblor.sinks import (
    debug_console,
    file_batch_sink,
    forget_covered,
    jdbc_batch_sink,
    write_jdbc,
    write_kafka,
    write_snapshot,
    write_table,
)
from temblor.sinks.stream import BatchSink
from temblor.sources import (
    flatten_geojson,
    read_geojson,
    read_geojson_features,
    read_quake_stream,
    read_quakes_csv,
    read_table,
    release_slices,
    replay_slices,
    stage_slices,
    write_slices,
)

CLEAN_TABLE = "preprocessed_quakes"

BATCH_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "tsunami_by_significance": plans.tsunami_by_significance,
    "average_magnitude": plans.average_magnitude,
    "state_frequency": plans.state_frequency,
    "depth_running": plans.depth_running,
    "depth_per_state": plans.depth_per_state,
    "ratio_gt3_per_state": plans.ratio_gt3_per_state,
    "yearly_tsunami_share": plans.yearly_tsunami_share,
    "hemisphere_monthly": plans.hemisphere_monthly,
    "event_pairs": plans.event_pairs,
    "equator_monthly_average": plans.equator_monthly_average,
    "events_on_day": plans.events_on_day,
    "largest_aftershock": plans.largest_aftershock,
    "foreshock_pairs": plans.foreshock_pairs,
    "largest_foreshock": plans.largest_foreshock,
}


def run_batch(
    spark: SparkSession,
    csv_path: str,
    write: Callable[[DataFrame, str], None],
    table: str = CLEAN_TABLE,
    table_path: str | None = None,
) -> None:
    """Clean the raw file into a table, then answer every batch question from it.

    The table is read anew by each query and not cached: a columnar scan of two to five pruned
    columns is cheaper than holding all of them in memory.
    """
    write_table(plans.preprocess_quakes(read_quakes_csv(spark, csv_path)), table, table_path)
    quakes = read_table(spark, table)
    for name, query in BATCH_QUERIES.items():
        write(query(quakes), name)


@dataclass(frozen=True)
class Limits:
    """What streams may drop: rows later than `delay`, pairs more than `join_bound` seconds apart.

    None drops nothing, and keeps all state.
    """

    delay: str | None
    join_bound: int | None


@dataclass(frozen=True)
class StreamJob:
    """One streaming result: how to build it, and when and how it is written."""

    build: Callable[[DataFrame, DataFrame, "Limits"], DataFrame]
    mode: str
    every: str


# The first stream carries 15-minute slices, the second 300-minute slices.
STREAM_JOBS: dict[str, StreamJob] = {
    "stream_avg_magnitude": StreamJob(
        lambda a, b, x: streaming.stream_avg_magnitude(a, delay=x.delay), "update", "60 seconds"
    ),
    "stream_all": StreamJob(lambda a, b, x: streaming.stream_all(a), "append", "30 seconds"),
    "stream_equator_max": StreamJob(
        lambda a, b, x: streaming.stream_equator_max(b, delay=x.delay), "update", "30 seconds"
    ),
    "stream_equator_count_gt4": StreamJob(
        lambda a, b, x: streaming.stream_equator_count_gt4(b, delay=x.delay), "update", "30 seconds"
    ),
    "stream_location_join": StreamJob(
        lambda a, b, x: streaming.stream_location_join(a, b, x.join_bound, x.delay),
        "append",
        "30 seconds",
    ),
    "stream_count_gt3": StreamJob(
        lambda a, b, x: streaming.stream_count_gt3(a, delay=x.delay), "update", "120 seconds"
    ),
}


def run_streams(
    first: DataFrame,
    second: DataFrame,
    sink_for: Callable[[str], BatchSink],
    checkpoint_root: str,
    limits: Limits,
    continuous: bool = True,
    debug: bool = False,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start every streaming result from two streams of raw messages.

    Without a bound on the join, its rows are kept in a table under `checkpoint_root` and not in state.

    Without `continuous` each query takes what is there and stops. `debug` adds console copies;
    each of them reads its source and keeps its state a second time. Rows from Kafka carry their
    origin into the tables that only ever grow.
    """
    a, b = (
        streaming.parse_quakes(raw, with_origin="offset" in raw.columns)
        for raw in (first, second)
    )
    root = checkpoint_root.rstrip("/")
    results = {name: (job.build(a, b, limits), sink_for(name)) for name, job in STREAM_JOBS.items()}
    if limits.join_bound is None:
        joined = "stream_location_join"
        stored = streaming.stored_join_sink(f"{root}/{joined}_history", sink_for(joined))
        results[joined] = (streaming.both_sides(a, b), stored)
    queries = [
        streaming.start_changelog(
            *results[name],
            name,
            f"{root}/{name}",
            job.mode,
            job.every if continuous else None,
            state_partitions,
        )
        for name, job in STREAM_JOBS.items()
    ]
    if debug:
        raw = first.select(first["value"].cast("string"))
        shown = {
            "join": (STREAM_JOBS["stream_location_join"].build(a, b, limits), "append"),
            "raw": (raw, "append"),
            "second": (b, "append"),
            "average": (streaming.stream_avg_magnitude(a), "complete"),
            "count": (streaming.stream_count_gt3(a), "complete"),
        }
        with session_conf(first.sparkSession, STREAM_DEFAULTS):
            queries += [
                debug_console(df, mode)
                .option("checkpointLocation", f"{root}/debug_{name}")
                .start()
                for name, (df, mode) in shown.items()
            ]
    return queries


def compact(spark: SparkSession, path: str, keys: tuple[str, ...], upto: int | None = None, forget: bool = False) -> int | None:
    """Fold a changelog, or with no `keys` the history of a stored join, into a snapshot.

    Streams and readers may go on meanwhile. `forget` removes what the snapshot covers.
    """
    if not keys:
        covered = streaming.fold_history(spark, path)
    else:
        schema = spark.read.parquet(path).drop("batch_id").schema
        covered = write_snapshot(spark, path, schema, lambda rows: compacted(rows, keys), upto)
    if forget:
        forget_covered(spark, path)
    return covered


def publish(messages: DataFrame, slice_minutes: int, write: Callable[[DataFrame], None]) -> None:
    """Hand flattened messages to `write` with the number of the time slice they belong to."""
    write(replay_slices(messages, slice_minutes, column="time"))


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = build_session(f"temblor-{args.program}", hive=args.hive)
    if args.program == "compact":
        compact(spark, args.changelog.rstrip("/"), tuple(args.keys or ()), args.upto, args.forget)
        return
    if args.program == "publish":
        if args.cut:
            messages = read_geojson_features(spark, args.geojson)
        else:
            messages = flatten_geojson(read_geojson(spark, args.geojson, args.one_per_file))
        if args.output:
            if not args.in_order:
                publish(messages, args.slice_minutes, lambda df: write_slices(df, args.output))
                return
            day = max(1, 24 * 60 // args.slice_minutes)
            publish(messages, args.slice_minutes, lambda df: stage_slices(df, args.output, day))
            release_slices(spark, args.output, pause=args.pause)
        else:
            # Sorted by slice and time, as far as partitions of the topic keep an order.
            topic = KafkaTopic(*args.kafka.rsplit("/", 1))
            publish(
                messages,
                args.slice_minutes,
                lambda df: write_kafka(df.sort("slice_id", "time").drop("slice_id"), topic),
            )
        return
    target = None
    if args.jdbc_url:
        target = JdbcTarget(
            args.jdbc_url,
            args.jdbc_driver,
            os.environ.get("TEMBLOR_JDBC_USER"),
            os.environ.get("TEMBLOR_JDBC_PASSWORD"),
            args.jdbc_connections,
        )
    out = args.output.rstrip("/") if args.output else None

    if args.program == "batch":
        table_path = args.table_path or (f"{out}/{args.table}" if out else None)
        if not table_path and not args.hive:
            raise SystemExit("with --jdbc-url, say where the table lies: --table-path, or --hive")
        write = (
            (lambda df, name: write_jdbc(df, target, name))
            if target
            else (lambda df, name: df.write.mode("overwrite").parquet(f"{out}/{name}"))
        )
        run_batch(spark, args.csv, write, args.table, table_path)
        return

    sink_for = (
        (lambda name: jdbc_batch_sink(target, name))
        if target
        else (lambda name: file_batch_sink(f"{out}/{name}"))
    )
    first, second = (
        read_quake_stream(spark, KafkaTopic(*source.rsplit("/", 1)))
        for source in (args.first, args.second)
    )
    queries = run_streams(
        first,
        second,
        sink_for,
        args.checkpoints,
        Limits(args.delay, args.join_bound),
        debug=args.debug,
        state_partitions=args.state_partitions,
    )
    streaming.await_all(spark, queries)


def _or_none(kind: Callable[[str], object]) -> Callable[[str], object]:
    return lambda text: None if text == "none" else kind(text)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="python -m temblor.jobs")
    programs = parser.add_subparsers(dest="program", required=True)
    batch = programs.add_parser("batch", help="clean a CSV file and answer the batch questions")
    batch.add_argument("--csv", required=True)
    batch.add_argument("--table", default=CLEAN_TABLE)
    batch.add_argument(
        "--table-path",
        help="where the table lies; by default under --output. Without a path, a later run can "
        "only replace the table if the catalog still knows it (--hive)",
    )
    stream = programs.add_parser("stream", help="process two topics until stopped")
    stream.add_argument("--first", required=True, metavar="BROKERS/TOPIC")
    stream.add_argument("--second", required=True, metavar="BROKERS/TOPIC")
    stream.add_argument("--checkpoints", required=True, help="folder on shared storage")
    stream.add_argument(
        "--delay", required=True, type=_or_none(str), help="e.g. '6 hours'; none drops no row"
    )
    stream.add_argument(
        "--join-bound", required=True, type=_or_none(int), help="seconds; none joins all pairs, from a stored history"
    )
    stream.add_argument("--state-partitions", type=int, help="fixed once a checkpoint exists")
    stream.add_argument("--debug", action="store_true", help="also show results on the console")
    publisher = programs.add_parser("publish", help="flatten GeoJSON and publish it in time slices")
    publisher.add_argument("--geojson", required=True)
    publisher.add_argument("--one-per-file", action="store_true", help="else one document a line")
    publisher.add_argument("--cut", action="store_true", help="cut large documents where features open")
    publisher.add_argument("--slice-minutes", type=int, default=15)
    publisher.add_argument(
        "--in-order", action="store_true", help="a folder per day, released one after the other"
    )
    publisher.add_argument("--pause", type=float, default=0, help="seconds between two days")
    publisher.add_argument("--hive", action="store_true", help="use the cluster's metastore")
    to = publisher.add_mutually_exclusive_group(required=True)
    to.add_argument("--output", help="folder for message files, one folder per slice unless --in-order")
    to.add_argument("--kafka", metavar="BROKERS/TOPIC")
    folder = programs.add_parser("compact", help="fold the batches of a changelog into a snapshot")
    folder.add_argument("--changelog", required=True, help="folder of one streaming result")
    folder.add_argument("--keys", nargs="*", help="e.g. start end; none for a stored join's history")
    folder.add_argument("--upto", type=int, help="last batch; by default all but the newest")
    folder.add_argument("--forget", action="store_true", help="remove what the snapshot covers")
    folder.add_argument("--hive", action="store_true", help="use the cluster's metastore")
    for program in (batch, stream):
        sink = program.add_mutually_exclusive_group(required=True)
        sink.add_argument("--jdbc-url", help="user and password: TEMBLOR_JDBC_USER, _PASSWORD")
        sink.add_argument("--output", help="folder for parquet results")
        program.add_argument("--jdbc-driver", default="org.postgresql.Driver")
        program.add_argument(
            "--jdbc-connections", type=int, default=16, help="tasks that write at the same time"
        )
        program.add_argument("--hive", action="store_true", help="use the cluster's metastore")
    return parser


if __name__ == "__main__":
    main()
