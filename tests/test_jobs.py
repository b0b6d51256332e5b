"""The two programs, end to end on files."""

from __future__ import annotations

import pytest

from temblor import jobs
from temblor.config import shared_dir
from temblor.operators import latest_view
from temblor.sinks import file_batch_sink
from temblor.sources import read_text_stream
from temblor.streaming import await_all, parse_quakes, start_changelog, stream_avg_magnitude
from registry import tables
from tests.conftest import SMALL, rows


def test_batch_program_writes_every_result(spark, folder):
    csv = shared_dir(spark, "csv")
    tables.raw_quakes(spark, SMALL).write.csv(csv, header=True)
    written = {}

    def write(df, name):
        df.write.parquet(f"{folder}/{name}")
        written[name] = spark.read.parquet(f"{folder}/{name}").count()

    jobs.run_batch(spark, csv, write, "batch_program_quakes", shared_dir(spark, "table"))
    assert set(written) == set(jobs.BATCH_QUERIES)
    assert written["state_frequency"] == 50 and written["largest_aftershock"] == 8
    assert spark.table("batch_program_quakes").count() == 1000


def test_batch_program_runs_again_without_the_catalog(spark, folder):
    """A later session doesn't know the table; dropping it leaves its files, as the end of one does."""
    csv = shared_dir(spark, "csv")
    tables.raw_quakes(spark, SMALL).limit(200).write.csv(csv, header=True)
    results = []
    for _ in range(2):
        jobs.main(["batch", "--csv", csv, "--output", folder, "--table", "quakes_again"])
        results.append(rows(spark.read.parquet(f"{folder}/state_frequency")))
        spark.sql("DROP TABLE quakes_again")
    assert results[0] == results[1] and results[0]


def test_stream_program_writes_every_result(spark, folder):
    inbox = shared_dir(spark, "inbox")
    tables.messages(spark, SMALL).write.text(inbox)
    queries = jobs.run_streams(
        read_text_stream(spark, inbox),
        read_text_stream(spark, inbox),
        lambda name: file_batch_sink(f"{folder}/{name}"),
        shared_dir(spark, "checkpoints"),
        jobs.Limits(delay="6 hours", join_bound=5 * 3600),
        continuous=False,
    )
    assert len(queries) == 6
    await_all(spark, queries)
    parsed = parse_quakes(spark.read.text(inbox))
    written = spark.read.parquet(f"{folder}/stream_avg_magnitude")
    expected = stream_avg_magnitude(parsed)
    assert rows(latest_view(written).select(expected.columns)) == rows(expected)
    assert spark.read.parquet(f"{folder}/stream_all").count() == 1000
    assert spark.read.parquet(f"{folder}/stream_location_join").count() > 1000


def test_publish_program_writes_slices(spark, folder):
    documents = shared_dir(spark, "geojson")
    tables.documents(spark, SMALL).write.text(documents)
    jobs.main(["publish", "--geojson", documents, "--slice-minutes", "300", "--output", folder])
    parsed = parse_quakes(spark.read.text(folder))
    assert parsed.count() == 2000 and parsed.where("time IS NULL").isEmpty()
    assert spark.read.text(folder).select("slice_id").distinct().count() > 10


def test_a_failing_query_stops_the_others(spark, folder):
    inbox = shared_dir(spark, "inbox")
    tables.messages(spark, SMALL).write.text(inbox)
    messages = read_text_stream(spark, inbox)

    def fail(batch, batch_id):
        raise RuntimeError("no space left")

    bad = start_changelog(messages, fail, "bad", shared_dir(spark, "c"), "append")
    good = start_changelog(
        messages, file_batch_sink(folder), "good", shared_dir(spark, "c"), "append", "1 second"
    )
    with pytest.raises(Exception, match="no space left"):
        await_all(spark, [good, bad])
    assert not good.isActive


def test_arguments():
    parse = jobs._arguments().parse_args
    args = parse(["batch", "--csv", "in.csv", "--output", "out"])
    assert (args.program, args.csv, args.output, args.jdbc_url) == ("batch", "in.csv", "out", None)
    args = parse(
        ["stream", "--first", "k1:1,k2:2/a", "--second", "k:1/b", "--checkpoints", "c",
         "--jdbc-url", "jdbc:x", "--debug", "--delay", "none", "--join-bound", "900"]
    )
    assert (args.delay, args.join_bound, args.jdbc_connections) == (None, 900, 16)
    assert args.first.rsplit("/", 1) == ["k1:1,k2:2", "a"] and args.debug
    with pytest.raises(SystemExit):
        parse(["batch", "--csv", "in.csv"])


def test_publish_program_releases_days_in_order(spark, folder):
    documents, out = f"{folder}/in", f"{folder}/out"
    tables.documents(spark, SMALL).write.text(documents)
    jobs.main(["publish", "--geojson", documents, "--slice-minutes", "300", "--output", out, "--in-order"])
    days = [r.release for r in spark.read.text(out).select("release").distinct().orderBy("release").collect()]
    assert len(days) > 20 and spark.read.text(out).count() == 2 * 1000
