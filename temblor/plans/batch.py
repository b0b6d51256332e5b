"""The batch questions, each a function of the cleaned table and its parameters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temblor.functions import count_where, hemisphere, in_band, in_period, ratio
from temblor.operators import proximity_join, running_profile, strongest_near, within_reach

def tsunami_by_significance(df: DataFrame) -> DataFrame:
    """Events that raised a tsunami, most significant first (NULL significance last).

    The sort is total and distributed. Rows of equal significance come in no particular order;
    the tie-break by a hash of the row lets the range partitioning spread one hot value over many
    tasks, and is the same however the input is partitioned.
    """
    return (
        df.where("tsunami <> 0")
        .withColumn("_tie", F.xxhash64(*[f"`{name}`" for name in df.columns]))
        .orderBy(F.col("significance").desc(), "_tie")
        .drop("_tie")
    )


def average_magnitude(df: DataFrame) -> DataFrame:
    """Mean magnitude of all events."""
    return df.agg(F.avg("magnitude").alias("average_magnitude"))


def state_frequency(df: DataFrame, k: int = 50) -> DataFrame:
    """The `k` states with most events: count, events per day, mean magnitude.

    Days are midnights passed between first and last event; a state seen on one date only has
    a NULL rate. Ties at the cut are broken by name. A NULL state is left out, '' is not.
    """
    days = F.datediff(F.max("date"), F.min("date"))
    return (
        df.where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count("*").alias("total_occurrences"),
            ratio(F.count("*"), days).alias("frequency_per_day"),
            F.avg("magnitude").alias("average_magnitude"),
        )
        .orderBy(F.col("total_occurrences").desc(), "state")
        .limit(k)
    )


def depth_running(df: DataFrame) -> DataFrame:
    """Depth profile of each state: one row per distinct depth, aggregated up to that depth."""
    return running_profile(df, key="state", value="depth").select(
        "state",
        F.col("running_count").alias("total_occurrences"),
        F.col("running_average").alias("average_depth"),
        F.col("running_min").alias("min_depth"),
        F.round("running_max").alias("max_depth"),
    )


def depth_per_state(df: DataFrame) -> DataFrame:
    """Count and average, least and greatest depth of each state."""
    return df.groupBy("state").agg(
        F.count("*").alias("total_occurrences"),
        F.avg("depth").alias("average_depth"),
        F.min("depth").alias("min_depth"),
        F.round(F.max("depth")).alias("max_depth"),
    )


def ratio_gt3_per_state(df: DataFrame, threshold: float = 3) -> DataFrame:
    """Share of each state's events above `threshold`; a NULL magnitude counts as not above."""
    return (
        df.groupBy("state")
        .agg(
            F.count("*").alias("total_quakes"),
            count_where(F.col("magnitude") > threshold).alias("quakes_gt_3"),
        )
        .withColumn("ratio_gt_3", F.col("quakes_gt_3") / F.col("total_quakes"))
    )


def yearly_tsunami_share(df: DataFrame) -> DataFrame:
    """Events per year and the percentage of them with a tsunami flag of exactly 1."""
    return (
        df.groupBy(F.year("date").alias("year"))
        .agg(
            F.count("*").alias("total_quakes"),
            count_where(F.col("tsunami") == 1).alias("quakes_with_tsunami"),
        )
        .withColumn(
            "percentage_with_tsunami",
            F.col("quakes_with_tsunami") / F.col("total_quakes") * 100,
        )
    )


def hemisphere_monthly(df: DataFrame, threshold: float = 6) -> DataFrame:
    """Mean and top magnitude, and events above `threshold`, by calendar month and hemisphere."""
    return df.groupBy(
        F.month("date").alias("month"), hemisphere(F.col("latitude")).alias("hemisphere")
    ).agg(
        F.avg("magnitude").alias("average_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        count_where(F.col("magnitude") > threshold).alias("count_gt_6_magnitude"),
    )


def equator_monthly_average(df: DataFrame, band: float = 5, months: int = 12) -> DataFrame:
    """Events of each state within `band` degrees of the equator, in all and per `months`."""
    return (
        df.where(in_band(F.col("latitude"), band))
        .groupBy("state")
        .agg(F.count("*").alias("total_occurrences"))
        .withColumn("average_occurrences_per_month", F.col("total_occurrences") / months)
    )


def events_on_day(df: DataFrame, day: datetime = datetime(2000, 8, 2)) -> DataFrame:
    """Position, depth and magnitude of the events of one day."""
    return df.where(in_period(df, "date", day, day + timedelta(days=1))).select(
        "latitude", "longitude", "depth", "magnitude"
    )


def event_pairs(
    df: DataFrame,
    start: datetime = datetime(2019, 1, 1),
    end: datetime = datetime(2019, 2, 1),
    box: float = 0.1,
    seconds: int = 900,
) -> DataFrame:
    """Pairs of nearby events within `seconds`, at least one of them in [start, end).

    The earlier event comes first, so a pair is formed once. No partner can lie further outside
    the period than the time limit, which is pushed to the scan of both sides. Copies are
    removed before the join: the result is distinct, and c copies would make c x c pairs.
    Events that differ in position alone give one row, by `_first_of_equal`, without a shuffle
    of the pairs.
    """
    slack = timedelta(seconds=seconds + 1)
    near = _with_positions(_traits(df.where(in_period(df, "date", start - slack, end + slack))))
    pairs = proximity_join(near, near, box, seconds, "later", suffixes=("1", "2"), copies=False)
    pairs = pairs.where(in_period(pairs, "date1", start, end) | in_period(pairs, "date2", start, end))
    return _first_of_equal(pairs, ("1", "2"), box).select(
        "place1", "place2", "date1", "date2", "magnitude1", "magnitude2"
    )


def largest_aftershock(
    df: DataFrame, main: float = 8, box: float = 0.1, seconds: int = 18_000
) -> DataFrame:
    """For each event of at least `main`: the strongest weaker event soon after it, ties kept."""
    return _shock_columns(_largest_around_main(df, main, box, seconds, "after"), "aftershock")


def foreshock_pairs(
    df: DataFrame, main: float = 8, box: float = 0.1, seconds: int = 18_000
) -> DataFrame:
    """For each event of at least `main`: every weaker event shortly before it.

    Rows are distinct by `_first_of_equal`, which does not shuffle the pairs: they grow with the
    square of the events near a main one.
    """
    strong, weaker = (_with_positions(side) for side in _strong_and_weaker(df, main, box))
    pairs = proximity_join(strong, weaker, box, seconds, "before", suffixes=SIDES, copies=False)
    return _shock_columns(_first_of_equal(pairs, SIDES, box), "foreshock", distinct=False)


def largest_foreshock(
    df: DataFrame, main: float = 8, box: float = 0.1, seconds: int = 18_000
) -> DataFrame:
    """For each event of at least `main`: the strongest weaker event shortly before it."""
    return _shock_columns(_largest_around_main(df, main, box, seconds, "before"), "foreshock")


SIDES = ("_main", "_other")


def _traits(df: DataFrame) -> DataFrame:
    """What the proximity questions compare and report, exact copies merged.

    The merging starts within each task, before the shuffle.
    """
    return df.select("place", "date", "magnitude", "latitude", "longitude").distinct()


def _strong_and_weaker(df: DataFrame, main: float, box: float) -> tuple[DataFrame, DataFrame]:
    """Events of at least `main`, and the others in their areas; a NULL magnitude is in neither.

    The weaker side loses everything out of the strong side's reach before its first shuffle.
    """
    strong = _traits(df.where(F.col("magnitude") >= main))
    return strong, _traits(within_reach(df.where(F.col("magnitude") < main), of=strong, box=box))


def _largest_around_main(
    df: DataFrame, main: float, box: float, seconds: int, direction: str
) -> DataFrame:
    """Strong events with the strongest of the weaker events around them, ties kept.

    Strong events of the same date, magnitude and place are one main event and share a maximum.
    """
    strong = _traits(df.where(F.col("magnitude") >= main))
    weaker = df.where(F.col("magnitude") < main).select(*strong.columns)
    return strongest_near(
        strong,
        weaker,
        "magnitude",
        ("date", "magnitude", "place"),
        box,
        seconds,
        direction,
        suffixes=SIDES,
    )


def _shock_columns(pairs: DataFrame, kind: str, distinct: bool = True) -> DataFrame:
    """The direction of the join settles which event is the main one; nothing to reorder."""
    shocks = pairs.select(
        "place_main",
        F.col("place_other").alias(f"place_{kind}"),
        "date_main",
        F.col("date_other").alias(f"date_{kind}"),
        F.col("magnitude_main").alias("main_magnitude"),
        F.col("magnitude_other").alias(f"{kind}_magnitude"),
    )
    return shocks.distinct() if distinct else shocks


# What a pair reports of an event; events equal in it differ in position alone.
REPORTED = ("place", "date", "magnitude")


def _with_positions(traits: DataFrame) -> DataFrame:
    """Rows of `_traits` that can be joined, each with the positions of all its equals in REPORTED.

    The window shuffles the events, not the pairs. Its groups are events of one place at one moment.
    """
    located = traits.where(
        "abs(latitude) < double('infinity') AND abs(longitude) < double('infinity')"
        " AND date IS NOT NULL"
    )
    positions = F.collect_set(F.struct("latitude", "longitude"))
    return located.withColumn("positions", positions.over(Window.partitionBy(*REPORTED)))


def _first_of_equal(pairs: DataFrame, suffixes: tuple[str, str], box: float) -> DataFrame:
    """One pair for each distinct pair of reported events, with no shuffle of the pairs.

    Two pairs report the same when their events are equal in REPORTED, and so in time: they
    differ in position alone. Of those, the one with the smallest positions (first side first)
    stays; a pair goes if a smaller pair of positions of the same events lies within the box,
    tested as `proximity_join` tests it. Both sides come from `_with_positions`, over all rows
    that the join was given.
    """
    a, b = suffixes
    lat_a, lon_a, lat_b, lon_b = (f"`{c}{s}`" for s in (a, b) for c in ("latitude", "longitude"))
    near = (
        f"p.latitude - q.latitude BETWEEN -{float(box)}D AND {float(box)}D"
        f" AND p.longitude - q.longitude BETWEEN -{float(box)}D AND {float(box)}D"
    )
    smaller = (
        f"(p.latitude < {lat_a} OR (p.latitude = {lat_a} AND (p.longitude < {lon_a}"
        f" OR (p.longitude = {lon_a} AND (q.latitude < {lat_b}"
        f" OR (q.latitude = {lat_b} AND q.longitude < {lon_b}))))))"
    )
    earlier = f"exists(`positions{a}`, p -> exists(`positions{b}`, q -> {near} AND {smaller}))"
    # Most events have no equal: a pair of two single positions is its own first.
    alone = f"size(`positions{a}`) + size(`positions{b}`) = 2"
    return pairs.where(f"{alone} OR NOT {earlier}").drop(f"positions{a}", f"positions{b}")
