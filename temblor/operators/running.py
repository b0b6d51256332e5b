"""Running aggregates in value order that do not put a whole key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.config import shared_dir

TARGET_ROWS = 500_000
SUMS = ("n", "known", "total")


def running_profile(
    df: DataFrame, key: str, value: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Per (`key`, distinct `value`): count, average, least and greatest value up to it.

    Equals the ordered window `PARTITION BY key ORDER BY value RANGE UNBOUNDED PRECEDING`
    followed by a duplicate removal: peers share a row, NULL sorts first and is counted by the
    row count only. Columns: key, value, running_count, running_average, running_min,
    running_max.

    That window would sort every row of a hot key in one task. Here peers are first merged by an
    ordinary grouping; the merged rows are dealt out by ranges of (key, value) whose limits come
    from the data, so that a range holds about `target_rows` of them at most; sums run within each
    range of a key, and each adds the totals of the key's ranges below it. Only one row per range
    is ever gathered per key.

    The merged rows are written to the shared folder twice: to be counted, and with the number of
    their range, on which both uses of it must agree.
    """
    peers = value_ranges(df, key, value, target_rows)
    # Merged peers are unique within the key, so a row frame equals the range frame.
    within = f"(PARTITION BY grp, bucket ORDER BY `{value}` ROWS UNBOUNDED PRECEDING)"
    local = peers.selectExpr(
        "grp",
        "bucket",
        f"`{value}`",
        *[f"sum({name}) OVER {within} AS {name}" for name in SUMS],
    )
    below = "(PARTITION BY grp ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
    offsets = (
        local.groupBy("grp", "bucket")
        .agg(
            *[F.expr(f"max_by({name}, n) AS {name}") for name in SUMS],
            F.expr(f"min(`{value}`) AS least"),
        )
        .selectExpr(
            "grp",
            "bucket",
            *[
                f"coalesce(sum({name}) OVER {below.format('1 PRECEDING')}, 0) AS {name}_below"
                for name in SUMS
            ],
            f"min(least) OVER {below.format('CURRENT ROW')} AS least",
        )
    )
    return local.join(offsets, ["grp", "bucket"]).selectExpr(
        f"grp.key AS `{key}`",
        f"`{value}`",
        "n_below + n AS running_count",
        "(total_below + total) / nullif(known_below + known, 0) AS running_average",
        f"CASE WHEN `{value}` IS NOT NULL THEN least END AS running_min",
        f"`{value}` AS running_max",
    )


def value_ranges(df: DataFrame, key: str, value: str, target_rows: int) -> DataFrame:
    """grp, value, sums of its peers, and bucket: the number of the range that it is in."""
    merged = df.groupBy(key, value).agg(
        F.expr("count(*) AS n"),
        F.expr(f"count(`{value}`) AS known"),
        F.expr(f"coalesce(sum(CAST(`{value}` AS DOUBLE)), 0D) AS total"),
    )
    # Inside a struct a NULL key equals itself, so one partitioning by group and range serves the
    # window, the range totals and the join with what lies below.
    merged = _written(merged.selectExpr(f"named_struct('key', `{key}`) AS grp", f"`{value}`", *SUMS))
    # Limits are estimated from samples; aiming at half the target leaves room for that.
    ranges = max(1, -(-2 * merged.count() // target_rows))
    return _written(
        merged.repartitionByRange(int(ranges), "grp", value).selectExpr(
            "*", "spark_partition_id() AS bucket"
        )
    )


def _written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "running")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
