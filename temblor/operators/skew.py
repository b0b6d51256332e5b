"""Splitting of hot join keys."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILES = ("tile_left", "tile_right")
COPIES = ("copies_of_left", "copies_of_right")

# Copies of a row travel as rows that stand for this many of them at most.
CHUNK = 1000


def tile_hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int, copies: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Give both sides two extra join columns that cut a hot key into a matrix of tiles.

    For a key with l left and r right rows the left rows fall into ceil(l / hot_rows) strips
    and the right rows into ceil(r / hot_rows); each left row is repeated once per right strip
    and the other way round, so every (left, right) pair meets in exactly one tile of about
    hot_rows x hot_rows. Keys that are not hot get the single tile (0, 0). The strip is a hash of
    the row, the same at every attempt of a task, which leaves exact copies of a row in one strip.

    With `copies`, they are cut as well: equal rows of a hot key, and of hot keys only, come out as
    rows that stand for up to `CHUNK` of them each, with strips of their own, and every row has a number in
    a column of `COPIES`. Let `expand_copies` follow the join.

    Every key over `hot_rows` is cut, however many there are. The table of hot keys is joined by
    key like any other; Spark broadcasts it where it turns out to be small. Both inputs must be
    repeatable: counts are exact, so the two sides agree on the strips even if the table is
    computed twice.
    """
    names = [f"`{key}`" for key in keys]
    counted = right.selectExpr(*names, "0 AS l", "1 AS r")
    counted = counted.union(left.selectExpr(*names, "1 AS l", "0 AS r"))
    hot = (
        counted.groupBy(*names)
        .agg(F.expr("sum(l) AS l"), F.expr("sum(r) AS r"))
        .where(f"greatest(l, r) > {hot_rows}")
        .selectExpr(
            *names,
            f"ceil(l / {hot_rows}) AS left_strips",
            f"ceil(r / {hot_rows}) AS right_strips",
        )
    )
    cut = _cut_with_copies if copies else _cut
    return (
        cut(left, hot, list(keys), own="left", other="right"),
        cut(right, hot, list(keys), own="right", other="left"),
    )


def merge_copies(df: DataFrame, count: str) -> DataFrame:
    """One row of each kind, with the number of its copies in a column `count`."""
    columns = [f"`{name}`" for name in df.columns]
    return df.groupBy(*columns).agg(F.count("*").alias(count))


def expand_copies(pairs: DataFrame) -> DataFrame:
    """Pairs of rows with `COPIES`, each as often as its two numbers say; the two columns go.

    One side after the other, so that no array is longer than a chunk.
    """
    for name in COPIES:
        rest = [f"`{c}`" for c in pairs.columns if c != name]
        pairs = pairs.selectExpr(*rest, f"explode(sequence(1, {name})) AS copy").drop("copy")
    return pairs


def _cut(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    columns = [f"`{name}`" for name in df.columns]
    return df.join(hot, keys, "left").selectExpr(*columns, *_tiles(columns, own, other))


def _cut_with_copies(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    """Rows of other keys as they are; rows of hot keys merged, then cut as chunks of copies."""
    columns = [f"`{name}`" for name in df.columns]
    count = COPIES[own == "right"]
    alone = df.join(hot, keys, "left_anti").selectExpr(
        *columns, f"1 AS {count}", f"0L AS tile_{own}", f"0L AS tile_{other}"
    )
    merged = merge_copies(df.join(hot.select(*keys), keys, "left_semi").select(*columns), "copies")
    chunks = _numbered(merged, f"(copies - 1) DIV {CHUNK}", "chunk")
    size = f"CAST(least({CHUNK}L, copies - chunk * {CHUNK}L) AS INT) AS {count}"
    cut = chunks.join(hot, keys).selectExpr(
        *columns, size, *_tiles([*columns, "chunk"], own, other)
    )
    return alone.unionByName(cut)


def _numbered(df: DataFrame, last: str, name: str, levels: int = 3) -> DataFrame:
    """Each row once for every number from 0 to `last`, digit by digit to the base of `CHUNK`."""
    df = df.selectExpr("*", f"CAST({last} AS BIGINT) AS last", f"0L AS {name}")
    columns = [f"`{c}`" for c in df.columns if c != name]
    for level in range(levels - 1, -1, -1):
        # How many digits fit: all if the number so far lies below that of the last row.
        step = CHUNK**level
        most = f"CAST(least({CHUNK - 1}L, last DIV {step}L - {name} * {CHUNK}L) AS INT)"
        df = df.selectExpr(*columns, f"{name} AS high", f"explode(sequence(0, {most})) AS digit")
        df = df.selectExpr(*columns, f"high * {CHUNK}L + digit AS {name}")
    return df.drop("last")


def _tiles(columns: list[str], own: str, other: str) -> tuple[str, str]:
    # A key may be hot on one side and absent from the other: that is one strip, not none.
    own_strips, other_strips = (
        f"greatest(coalesce({side}_strips, 1L), 1L)" for side in (own, other)
    )
    return (
        f"coalesce(pmod(xxhash64({', '.join(columns)}), {own_strips}), 0L) AS tile_{own}",
        f"explode(sequence(0L, {other_strips} - 1L)) AS tile_{other}",
    )
