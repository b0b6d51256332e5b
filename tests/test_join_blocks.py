"""The stream join whose state holds blocks of rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.sinks import file_batch_sink, read_changelog
from temblor.streaming import joins, start_changelog, stream_location_join
from tests.conftest import rows

MESSAGE = "location string, magnitude double, time timestamp, origin string"
T0 = datetime(2024, 1, 1)


def _table(spark, *values):
    """Rows of (location, magnitude, seconds after T0), each with an origin of its own."""
    made = [
        (place, m, None if s is None else T0 + timedelta(seconds=s), f"o{k}") for k, (place, m, s) in enumerate(values)
    ]
    return spark.createDataFrame(made, MESSAGE)


def _random(seed, n, start=0, length=20_000):
    draw = random.Random(seed)
    moment = lambda: start + draw.randrange(length * 1000) / 1000
    whole = [(f"p{draw.randrange(3)}", draw.choice([None, 1.5, 2.5]), moment()) for _ in range(n)]
    return [*whole, (None, 1.0, start), ("p1", 1.0, None), whole[0]]


def _streamed(spark, folder, batches, bound, delay, block_rows, **more):
    """Pairs of a stream that meets the tables of `batches` one after the other, and what its state held after each."""
    inboxes, checkpoint, out, held = (f"{folder}/1", f"{folder}/2"), f"{folder}/checkpoint", f"{folder}/out", []
    for tables in batches:
        for inbox, table in zip(inboxes, tables):
            table.coalesce(1).write.mode("append").parquet(inbox)
        first, second = (spark.readStream.schema(MESSAGE).parquet(inbox) for inbox in inboxes)
        joined = stream_location_join(first, second, bound, delay, block_rows=block_rows, **more)
        query = start_changelog(joined, file_batch_sink(out), "blocks", checkpoint, "append")
        query.awaitTermination()
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    return read_changelog(spark, out, joined.schema).drop("batch_id"), held


@pytest.mark.parametrize("bound, strips, pack_rows", [(1, 1, 500_000), (900, 1, 7), (900, 3, 500_000), (90_000, 1, 7)])
def test_blocks_give_the_pairs_of_the_rows(spark, folder, monkeypatch, bound, strips, pack_rows):
    monkeypatch.setattr(joins, "PACK_ROWS", pack_rows)
    edge = [("edge", 1.0, 50.007 + gap) for gap in (bound, -bound, bound + 0.001, -bound - 0.001)]
    batches = [
        (_table(spark, *_random(k, 40), *[("edge", None, 50.007)] * (k == 0)), _table(spark, *_random(k + 9, 40), *edge))
        for k in range(3)
    ]
    got, _ = _streamed(spark, folder, batches, bound, "60 hours", 4, strips=strips)
    whole = [a.unionByName(b).unionByName(c) for a, b, c in zip(*batches)]
    want = stream_location_join(*whole, bound)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert want.where("location = 'edge' AND magnitude1 IS NULL").count() == 6
    assert rows(stream_location_join(*whole, bound, block_rows=4)) == rows(want)


def test_state_holds_a_block_where_it_held_its_rows(spark, folder):
    """640 rows a side at one place and moment: the pairs are all there, and state is ten blocks a side and bucket."""
    busy = _table(spark, *[("busy", float(k), 2000 + k / 1000) for k in range(640)])
    got, held = _streamed(spark, folder, [(busy, busy)], 900, "2 hours", 64)
    assert got.count() == 640 * 640 and got.distinct().count() == 640 * 640
    assert held[0] <= 30


def test_blocks_are_forgotten_and_hold_no_row_back(spark, folder):
    """Old blocks leave the state; a row within the delay still meets what is due to it."""
    later = 40 * 3600
    batches = [
        (_table(spark, *_random(1, 50)), _table(spark, *_random(2, 50))),
        (_table(spark, *_random(3, 50, later)), _table(spark, *_random(4, 50, later))),
        # Late by nearly the delay, in a block with rows that are not late at all.
        (_table(spark, ("p1", 9.0, later - 3500), ("p1", 9.0, later + 10)), _table(spark, ("p1", 8.0, later - 3400))),
        (_table(spark, ("p2", 1.0, 2 * later)), _table(spark, ("p2", 1.0, 2 * later))),
    ]
    got, held = _streamed(spark, folder, batches, 900, "7 hours", 8)
    whole = [batches[0][side] for side in (0, 1)]
    for tables in batches[1:]:
        whole = [w.unionByName(t) for w, t in zip(whole, tables)]
    want = stream_location_join(*whole, 900)
    assert rows(got) == rows(want) and want.where("magnitude1 = 9 AND magnitude2 = 8").count() == 1
    assert held[0] > 10 and held[-1] <= 3
