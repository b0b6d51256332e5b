"""Operators against plain formulations on random rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from temblor.config import session_conf
from temblor.operators import (
    compacted,
    latest_view,
    expand_copies,
    merge_copies,
    proximity_join,
    running_profile,
    strongest_near,
    tile_hot_keys,
    within_reach,
)
from temblor.operators.running import value_ranges
from tests.conftest import plan_text, rows


def _events(spark, n: int, seed: int, kind: str = "float", spread: float = 1.0):
    rng = random.Random(seed)
    start = datetime(1969, 12, 31, 12)
    data = []
    for i in range(n):
        lat, lon = (rng.uniform(-spread, spread) for _ in range(2))
        if rng.random() < 0.4:
            # On cell edges and multiples of the box, negative ones included.
            lat, lon = (rng.randrange(-10, 11) * rng.choice([0.1, 0.125, 0.25]) for _ in range(2))
        date = start + timedelta(milliseconds=rng.randrange(0, 6 * 3600 * 1000, 250))
        if rng.random() < 0.3:
            date = start + timedelta(seconds=450 * rng.randrange(0, 48))
        data.append((i, lat, lon, date))
    data += [
        (n, None, 0.0, start),
        (n + 1, 0.0, float("nan"), start),
        (n + 2, float("inf"), 0.0, start),
        (n + 3, float("inf"), 0.0, start + timedelta(seconds=1)),
        (n + 4, 1e30, 1e30, start),
        (n + 5, 0.0, 0.0, None),
    ]
    return spark.createDataFrame(
        data, f"id INT, latitude {kind}, longitude {kind}, date TIMESTAMP"
    )


TIME_TESTS = {
    "both": "l.date <> r.date AND abs(unix_timestamp(l.date) - unix_timestamp(r.date)) <= {t}",
    "after": "unix_timestamp(r.date) - unix_timestamp(l.date) BETWEEN 1 AND {t}",
    "before": "unix_timestamp(l.date) - unix_timestamp(r.date) BETWEEN 1 AND {t}",
    "later": "r.date > l.date AND unix_timestamp(r.date) - unix_timestamp(l.date) <= {t}",
}


def _theta(left, right, box: float, seconds: int, direction: str):
    test = f"""
      l.latitude - r.latitude BETWEEN -double('{box}') AND double('{box}') AND
      l.longitude - r.longitude BETWEEN -double('{box}') AND double('{box}') AND
    """ + TIME_TESTS[direction].format(t=seconds)
    pairs = left.alias("l").join(right.alias("r"), F.expr(test))
    return pairs.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


@pytest.mark.parametrize("direction", list(TIME_TESTS))
@pytest.mark.parametrize("kind", ["float", "double"])
def test_proximity_join_equals_the_theta_join(spark, direction, kind):
    left, right = _events(spark, 350, 1, kind), _events(spark, 500, 2, kind)
    expected = rows(_theta(left, right, 0.1, 900, direction))
    assert len(expected) > 20
    for hot_rows in (20_000, 3):
        found = proximity_join(left, right, 0.1, 900, direction, hot_rows=hot_rows)
        assert rows(found.select("id_left", "id_right")) == expected


@pytest.mark.parametrize("box,seconds", [(0.125, 1), (0.3, 60), (1.0, 18_000), (10.0, 86_400)])
def test_proximity_join_with_other_limits(spark, box, seconds):
    events = _events(spark, 250, 3)
    expected = rows(_theta(events, events, box, seconds, "both"))
    found = proximity_join(events, events, box, seconds, hot_rows=50)
    assert rows(found.select("id_left", "id_right")) == expected


def test_proximity_join_keeps_copies(spark):
    a = spark.createDataFrame(
        [(1, 0.0, 0.0, datetime(2020, 1, 1))] * 3,
        "id INT, latitude FLOAT, longitude FLOAT, date TIMESTAMP",
    )
    b = a.withColumn("date", F.expr("date + interval 1 minute"))
    assert proximity_join(a, b).count() == 9
    assert proximity_join(a, b, hot_rows=1).count() == 9


def test_proximity_join_refuses_an_unknown_direction(spark):
    events = _events(spark, 1, 4)
    with pytest.raises(ValueError, match="direction"):
        proximity_join(events, events, direction="sideways")


def test_within_reach_loses_no_partner(spark):
    left, right = _events(spark, 60, 5, spread=30.0), _events(spark, 600, 6, spread=30.0)
    near = within_reach(right, of=left, box=0.1)
    assert near.count() < right.count()
    expected = rows(_theta(left, right, 0.1, 80_000, "both"))
    assert rows(_theta(left, near, 0.1, 80_000, "both")) == expected


def test_one_hot_cell_is_spread_over_many_tiles(spark):
    """A cell with a third of all rows: no tile exceeds the limit, no pair is lost."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    left, right = spark.range(3000).select("id", key), spark.range(900).select("id", key)
    a, b = tile_hot_keys(left, right, ["k"], hot_rows=100)
    tile = ["k", "tile_left", "tile_right"]
    left_tiles = {tuple(r[:3]): r[3] for r in a.groupBy(*tile).count().collect()}
    right_tiles = {tuple(r[:3]): r[3] for r in b.groupBy(*tile).count().collect()}
    assert len([t for t in left_tiles if t[0] == 0]) == 10 * 3
    assert max(left_tiles.values()) < 200 and max(right_tiles.values()) < 200
    paired = a.withColumnRenamed("id", "a").join(b.withColumnRenamed("id", "b"), tile)
    plain = left.withColumnRenamed("id", "a").join(right.withColumnRenamed("id", "b"), "k")
    assert paired.count() == plain.count()
    assert rows(paired.groupBy("k").count()) == rows(plain.groupBy("k").count())
    assert paired.select("a", "b").distinct().count() == plain.count()


def test_a_hot_left_side_is_cut_as_well(spark):
    left = spark.range(3000).select("id", F.lit(0).alias("k"))
    right = spark.range(10).select("id", F.lit(0).alias("k"))
    a, b = tile_hot_keys(left, right, ["k"], hot_rows=100)
    strips = [r[1] for r in a.groupBy("tile_left").count().collect()]
    assert len(strips) == 30 and max(strips) < 200
    assert b.count() == 10 * 30


def test_copies_are_merged_before_and_dealt_out_after_the_join(spark):
    """3,000 copies a side make one pair of rows, not a tile of 3,000 x 3,000."""
    one = spark.range(3000).select(
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
        F.timestamp_seconds(F.lit(1000)).alias("date"), F.lit("p").alias("place"),
    )
    other = one.limit(400).withColumn("date", F.timestamp_seconds(F.lit(1060)))
    pairs = proximity_join(one, other, hot_rows=100)
    assert pairs.count() == 3000 * 400
    merged = merge_copies(one, "copies")
    assert merged.collect()[0]["copies"] == 3000 and merged.count() == 1


def test_fifty_thousand_copies_a_side(spark):
    """2.5 billion pairs of equal rows, counted without an array of them."""
    def same(n, second):
        return spark.range(n).selectExpr(
            "1.0D AS latitude", "2.0D AS longitude", f"timestamp_seconds({second}) AS date"
        )

    left, right = same(50_000, 100).union(same(3, 101)), same(50_000, 160)
    pairs = proximity_join(left, right)
    assert pairs.count() == 50_003 * 50_000
    assert "array_repeat" not in plan_text(pairs)


def test_copies_of_hot_keys_travel_in_chunks(spark):
    rows_of = spark.range(5200).selectExpr("CAST(greatest(id - 5000, 0) AS INT) AS id", "0 AS k")
    few = spark.range(2).selectExpr("CAST(id AS INT) AS other", "0 AS k")
    a, b = tile_hot_keys(rows_of, few, ["k"], hot_rows=1000, copies=True)
    chunks = a.where("id = 0").collect()
    assert sum(r["copies_of_left"] for r in chunks) == 5001 and len(chunks) == 6
    assert max(r["copies_of_left"] for r in chunks) == 1000
    assert len({r["tile_left"] for r in chunks}) > 1
    paired = expand_copies(a.join(b, ["k", "tile_left", "tile_right"]))
    plain = rows_of.join(few, "k")
    assert rows(paired.groupBy("id", "other").count()) == rows(plain.groupBy("id", "other").count())


def test_copies_of_other_keys_are_not_shuffled_to_be_merged(spark):
    table = spark.range(60).selectExpr("id % 3 AS id", "id % 20 AS k")
    a, b = tile_hot_keys(table, table.withColumnRenamed("id", "other"), ["k"], hot_rows=50, copies=True)
    assert a.count() == 60 and {r[0] for r in a.select("copies_of_left").collect()} == {1}
    paired = expand_copies(a.join(b, ["k", "tile_left", "tile_right"]))
    assert paired.count() == 20 * 9


@pytest.mark.parametrize("box,seconds,direction", [(0.1, 900, "both"), (0.3, 60, "later"), (1.0, 18_000, "after"), (10.0, 86_400, "before")])
@pytest.mark.parametrize("hot_rows", [20_000, 2])
def test_strongest_near_against_all_pairs(spark, box, seconds, direction, hot_rows):
    events = _events(spark, 300, 11).withColumn("strength", F.expr("CAST(id * 37 % 11 AS DOUBLE)"))
    events = events.withColumn("name", F.expr("IF(id % 5 = 0, NULL, id % 4)"))
    main, other = events.where("strength > 7"), events.where("strength <= 7")
    pairs = proximity_join(main, other, box, seconds, direction, suffixes=("_main", "_other"))
    pairs.createOrReplaceTempView("all_pairs")
    expected = spark.sql("""SELECT id_main, id_other FROM (SELECT *, max(strength_other) OVER
        (PARTITION BY date_main, name_main) AS best FROM all_pairs) WHERE strength_other = best""")
    found = strongest_near(
        main, other, "strength", ("date", "name"), box, seconds, direction, hot_rows=hot_rows
    )
    assert rows(found.select("id_main", "id_other")) == rows(expected)


def test_strongest_near_keeps_ties_and_copies(spark):
    main = spark.sql("SELECT 0.0D AS latitude, 0.0D AS longitude, timestamp_seconds(1000) AS date, 9.0D AS strength")
    other = spark.range(3000).selectExpr(
        "0.05D AS latitude", "0.0D AS longitude", "timestamp_seconds(1000 + id % 5) AS date", "IF(id % 5 = 0, 7.0D, 6.0D) AS strength"
    )
    found = strongest_near(main, other, "strength", ("date",), 0.1, 60, "both", hot_rows=50)
    assert found.count() == 2400 and {r[0] for r in found.select("strength_other").collect()} == {6.0}
    assert strongest_near(main, other.where("strength > 9"), "strength", ("date",)).count() == 0


def test_a_key_hot_on_one_side_only(spark):
    left = spark.range(500).select("id", F.lit(0).alias("k"))
    right = spark.range(1).select(F.lit(7).alias("other"), F.lit(1).alias("k"))
    a, b = tile_hot_keys(left, right, ["k"], hot_rows=50)
    assert a.count() == 500 and b.count() == 1
    assert a.select("tile_left").distinct().count() > 5


def test_every_hot_key_is_cut(spark):
    left = spark.range(1000).select("id", (F.col("id") % 20).alias("k"))
    a, b = tile_hot_keys(left, left, ["k"], hot_rows=10)
    assert a.where("tile_right > 0").select("k").distinct().count() == 20
    pairs = a.join(b.withColumnRenamed("id", "id2"), ["k", "tile_left", "tile_right"])
    assert pairs.count() == 20 * 50 * 50


def test_hot_cell_counting_shares_the_shuffle_of_the_join(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("ts").alias("date"),
        (F.col("user_id") * 1.0).alias("latitude"),
        (F.col("event_id") % 7 * 1.0).alias("longitude"),
    )
    distinct = events.distinct()
    result = proximity_join(distinct, distinct)
    result.collect()
    final = plan_text(result, "simple").split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_proximity_join_with_an_equal_column(spark):
    left, right = _events(spark, 300, 7), _events(spark, 300, 8)
    a, b = left.withColumn("x", F.col("id") % 3), right.withColumn("y", F.col("id") % 3)
    pairs = rows(_theta(left, right, 0.3, 900, "both"))
    expected = [p for p in pairs if p[0] % 3 == p[1] % 3]
    assert expected
    found = proximity_join(a, b, 0.3, 900, equal=("x", "y"), hot_rows=2)
    assert rows(found.select("id_left", "id_right")) == expected


@pytest.mark.parametrize("kind", ["float", "double", "int"])
def test_running_profile_equals_the_ordered_window(spark, kind):
    rng = random.Random(9)
    special = [None, 0.0, -0.0, -3.5, 1e30, -1e30, float("inf"), float("-inf"), float("nan")]
    data = []
    for _ in range(1500):  # eighths, so that sums are exact in any order
        key = rng.choice(["hot", "hot", "warm", "cold", None])
        if kind == "int":
            value = rng.choice([None, rng.randrange(-50, 800)])
        elif key == "cold":
            value = rng.choice(special)
        else:
            value = rng.choice([None, rng.randrange(-40, 6000) / 8])
        data.append((key, value))
    df = spark.createDataFrame(data, f"k STRING, v {kind}")
    window = (
        Window.partitionBy("k")
        .orderBy("v")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    expected = df.select(
        "k",
        "v",
        F.count("*").over(window).alias("n"),
        F.avg("v").over(window).alias("a"),
        F.min("v").over(window).alias("lo"),
        F.max("v").over(window).alias("hi"),
    ).dropDuplicates()
    for target_rows in (500_000, 60):
        assert _as_text(running_profile(df, "k", "v", target_rows)) == _as_text(expected)


def _as_text(df) -> list[str]:
    """NaN differs from itself, so compare text; adding 0 turns -0.0, a peer of 0.0, into it."""
    number = [F.col(c) + F.lit(0).cast(t) for c, t in df.dtypes[1:]]
    return sorted({str(tuple(r)) for r in df.select(df.columns[0], *number).collect()})


@pytest.mark.parametrize("value", ["10 + id / 2e6", "CAST(id / 2e7 AS FLOAT)"])
def test_no_range_of_close_values_exceeds_the_target(spark, value):
    df = spark.range(200_000).selectExpr("'hot' AS k", f"{value} AS v")
    sizes = [r[0] for r in value_ranges(df, "k", "v", 20_000).groupBy("grp", "bucket").count().select("count").collect()]
    assert sum(sizes) == df.select("v").distinct().count() and max(sizes) <= 20_000


def test_running_profile_gathers_one_row_per_bucket_and_key(spark):
    """The window over a whole key sees bucket totals; rows are only sorted within a bucket."""
    df = spark.range(50_000).select(
        F.lit("hot").alias("k"), (F.col("id") % 5000 / 8).cast("float").alias("v")
    )
    result = running_profile(df, "k", "v")
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert result.count() == 5000
        # Merged peers move twice: to be merged, and to their bucket. The rest are bucket totals.
        plan = plan_text(running_profile(df, "k", "v"), "simple")
    assert plan.count("Exchange hashpartitioning(k#") <= 2
    assert plan.count("isnull") == 0
    last = result.orderBy(F.desc("v")).first()
    assert (last["running_count"], last["running_min"]) == (50_000, 0.0)


def test_latest_view_takes_the_newest_and_ignores_repeats(spark):
    log = spark.createDataFrame(
        [(1, 2, 0, 5.0), (1, 2, 3, 7.0), (1, 2, 3, 7.0), (2, 3, 1, None)],
        "start INT, end INT, batch_id BIGINT, n DOUBLE",
    )
    assert rows(latest_view(log)) == [(1, 2, 7.0), (2, 3, None)]
