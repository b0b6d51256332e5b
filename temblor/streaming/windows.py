"""Event-time tumbling windows over parsed messages.

Each function takes and returns a DataFrame and works on bounded input as well. `delay` is how
late a row may be: with it, state is bounded and rows that come later are dropped; with None, by
default, none is dropped and all windows are kept. It should exceed the longest replayed slice.
Windows are aligned to the epoch. Rows without a time belong to no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.functions import in_band

def stream_avg_magnitude(
    df: DataFrame, window: str = "30 minutes", delay: str | None = None
) -> DataFrame:
    """Mean magnitude per window."""
    return _tumbling(df, None, window, delay, avg_magnitude=F.avg("magnitude"))


def stream_count_gt3(
    df: DataFrame, window: str = "60 minutes", threshold: float = 3.0, delay: str | None = None
) -> DataFrame:
    """Events above `threshold` per window."""
    strong = F.col("magnitude") > threshold
    return _tumbling(df, strong, window, delay, num_quakes_mag_gt3=F.count("*"))


def stream_equator_max(
    df: DataFrame, window: str = "300 minutes", band: float = 5, delay: str | None = None
) -> DataFrame:
    """Top magnitude near the equator per window."""
    near = in_band(F.col("latitude"), band)
    return _tumbling(df, near, window, delay, max_magnitude=F.max("magnitude"))


def stream_equator_count_gt4(
    df: DataFrame,
    window: str = "300 minutes",
    band: float = 5,
    threshold: float = 4.0,
    delay: str | None = None,
) -> DataFrame:
    """Events near the equator above `threshold` per window."""
    near_and_strong = in_band(F.col("latitude"), band) & (F.col("magnitude") > threshold)
    return _tumbling(df, near_and_strong, window, delay, count_gt4=F.count("*"))


def stream_all(df: DataFrame) -> DataFrame:
    """Every message as parsed, malformed ones included."""
    return df


def _tumbling(
    df: DataFrame, condition: Column | None, window: str, delay: str | None, **aggregate: Column
) -> DataFrame:
    """Spark moves the condition below the watermark: only rows that meet it advance it."""
    timed = df.withWatermark("time", delay) if delay else df
    kept = timed if condition is None else timed.where(condition)
    return (
        kept.groupBy(F.window("time", window))
        .agg(*[value.alias(name) for name, value in aggregate.items()])
        .select("window.start", "window.end", *aggregate)
    )
