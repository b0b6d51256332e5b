"""Every registered query against DuckDB, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from registry.oracle import ORACLE_SQL
from registry.queries import QUERIES
from registry import tables
from temblor.config import shared_dir
from temblor.sinks import file_batch_sink, read_changelog
from temblor.sources import read_text_stream
from temblor.streaming import parse_quakes, start_changelog, stream_count_gt3
from tests.conftest import SMALL, plan_text, rows

# Row counts expected of the test table.
EXPECTED_ROWS = {
    "tsunami_by_significance": 91,
    "average_magnitude": 1,
    "state_frequency": 50,
    "depth_running": 988,
    "depth_per_state": 51,
    "ratio_gt3_per_state": 51,
    "yearly_tsunami_share": 3,
    "hemisphere_monthly": 10,
    "event_pairs": 2,
    "equator_monthly_average": 5,
    "events_on_day": 1,
    "largest_aftershock": 8,
    "foreshock_pairs": 14,
    "largest_foreshock": 13,
    "stream_avg_magnitude": 720,
    "stream_count_gt3": 442,
    "stream_equator_max": 46,
    "stream_equator_count_gt4": 26,
    "stream_location_join": 1064,
}

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_limits_on_a_stored_date_reach_the_scan(spark):
    for name in ("event_pairs_stored_date", "events_on_stored_day"):
        pushed = plan_text(contract.queries()[name](spark, SMALL)).split("PushedFilters")[1].split("\n")[0]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    oracle = duck.sql(contract.oracle_sql()[name])
    columns = sorted(oracle.columns)
    assert sorted(df.columns) == columns
    expected_types = dict(zip(oracle.columns, map(str, oracle.types)))
    assert dict(df.dtypes) == {c: SPARK_TYPES[t] for c, t in expected_types.items()}
    position = [oracle.columns.index(c) for c in columns]
    expected = sorted(
        (tuple(r[i] for i in position) for r in oracle.fetchall()),
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    assert rows(df.select(columns)) == expected
    assert len(expected) == EXPECTED_ROWS.get(name, len(expected))


def test_files_in_order_of_time_are_batches_of_their_own(spark, folder):
    tables.write_in_order(spark, SMALL, folder, late=True)
    parsed = parse_quakes(read_text_stream(spark, folder, files_per_batch=1))
    out = shared_dir(spark, "changelog")
    windows = stream_count_gt3(parsed, delay="2 hours")
    start_changelog(windows, file_batch_sink(out), "in_order", shared_dir(spark, "c")).awaitTermination()
    changelog = read_changelog(spark, out, windows.schema)
    assert changelog.select("batch_id").distinct().count() >= tables.PARTS


def test_entry(spark):
    assert contract.entry(spark).count() == EXPECTED_ROWS["largest_aftershock"]


def test_tables_of_many_files_are_streamed_as_well(spark, folder):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    assert contract.queries()["stream_count_gt3"](spark, folder).count() == 442
