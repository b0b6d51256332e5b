"""The greatest value among the events around each main event."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.operators import proximity
from temblor.operators.skew import TILES, tile_hot_keys

CELL = ("cell_lat", "cell_lon", "cell_time")

# Coarse cells are folded onto this many numbers, which bounds the broadcast list of them.
COARSE_CELLS = 1 << 21


def strongest_near(
    main: DataFrame,
    other: DataFrame,
    value: str,
    event: Sequence[str],
    box: float = 0.1,
    seconds: int = 900,
    direction: str = "both",
    *,
    suffixes: tuple[str, str] = ("_main", "_other"),
    hot_rows: int = 20_000,
) -> DataFrame:
    """Pairs as `proximity_join` forms them, but of each main event only those of the greatest `value`.

    Rows of `main` that agree in the columns `event` are one main event; ties are all kept. `main`
    must be free of copies; copies in `other` come out as copies.

    The pairs are not formed to find their maximum. Fine cells keep their greatest value and one
    event that has it. A main event looks at the cells its reach meets, 3 x 3 x 3 at most; the events
    kept there that do lie within reach give a lower bound, and only cells whose greatest value is
    no less can hold an answer. Coarse cells pass the least bound of the main events around them
    on to the second reading of `other`, so that rows below it are dropped before any shuffle. What is left
    meets the main events, in tiles where a cell is still hot.
    """
    m = proximity._located(main).toDF(*[name + suffixes[0] for name in main.columns])
    here, there = (
        [f"`{name}{suffix}`" for name in ("latitude", "longitude", "date")] for suffix in suffixes
    )
    reach = box + proximity.REACH_MARGIN
    width, span = proximity.cell_width(reach) / 2, (seconds + 2) // 2
    back, ahead = proximity._time_reach(direction, seconds)

    near = proximity.within_reach(other, main, box)
    tops = near.selectExpr(
        *_cells("latitude", "longitude", "date", width, span),
        f"struct(`{value}` AS top, latitude, longitude, date) AS kept",
    )
    tops = tops.groupBy(*CELL).agg(F.max("kept").alias("kept"))

    lat, lon, time = (
        f"sequence({proximity._cell(f'({at} - {float(low)}D)', size)}, {proximity._cell(f'({at} + {float(high)}D)', size)})"
        for at, low, high, size in (
            (here[0], reach, reach, width),
            (here[1], reach, reach, width),
            (proximity._second(here[2]), back, ahead, span),
        )
    )
    cells = f"transform({time}, t -> struct(y AS cell_lat, x AS cell_lon, t AS cell_time))"
    cells = f"flatten(transform({lat}, y -> flatten(transform({lon}, x -> {cells}))))"
    met = m.selectExpr("*", f"inline({cells})").join(tops, list(CELL))
    inside = _within(here, ["kept.latitude", "kept.longitude", "kept.date"], box, seconds, direction)
    of_event = met.groupBy(*[f"`{name}`" for name in m.columns]).agg(
        F.expr(f"max(CASE WHEN {inside} THEN kept.top END) AS least"),
        F.expr(f"collect_list(struct({', '.join(CELL)}, kept.top)) AS cells"),  # 27 at most
    )
    # A cell without a bound has to be looked through; so has one that can equal it.
    bounded = of_event.selectExpr(
        *[f"`{name}`" for name in m.columns], "least", "inline(filter(cells, c -> least IS NULL OR c.top >= least))"
    ).drop("top")

    coarse = f"pmod(xxhash64(cell_lat DIV 2, cell_lon DIV 2, cell_time DIV 2), {COARSE_CELLS}L)"
    lowest = bounded.selectExpr(f"{coarse} AS coarse", "least").groupBy("coarse").agg(
        F.expr("min(coalesce(least, double('-infinity')))").alias("lowest")
    )
    rows = proximity._located(other)
    rows = rows.toDF(*[name + suffixes[1] for name in other.columns])
    theirs = f"`{value}{suffixes[1]}`"
    rows = rows.selectExpr("*", *_cells(*there, width, span)).selectExpr("*", f"{coarse} AS coarse")
    rows = rows.join(F.broadcast(lowest), "coarse").where(f"{theirs} >= lowest").drop("coarse", "lowest")

    left, right = tile_hot_keys(bounded, rows, CELL, hot_rows)
    exact = _within(here, there, box, seconds, direction)
    pairs = left.join(right, [*CELL, *TILES]).where(f"{exact} AND (least IS NULL OR {theirs} >= least)")
    pairs = pairs.select(*[f"`{name}`" for name in (*m.columns, *[c + suffixes[1] for c in other.columns])])
    best = pairs.groupBy(*[F.col(f"`{name}{suffixes[0]}`").alias(f"of_{name}") for name in event]).agg(F.max(F.expr(theirs)).alias("best"))
    same = F.expr(" AND ".join(f"`{name}{suffixes[0]}` <=> of_{name}" for name in event) + f" AND {theirs} = best")
    return pairs.join(best, same).select(*pairs.columns)


def _cells(lat: str, lon: str, date: str, width: float, span: int) -> list[str]:
    values = (lat, lon, proximity._second(date))
    return [
        f"{proximity._cell(value, size)} AS {name}"
        for value, size, name in zip(values, (width, width, span), CELL)
    ]


def _within(here: Sequence[str], there: Sequence[str], box: float, seconds: int, direction: str) -> str:
    return (
        f"{here[0]} - {there[0]} BETWEEN -{float(box)}D AND {float(box)}D"
        f" AND {here[1]} - {there[1]} BETWEEN -{float(box)}D AND {float(box)}D"
        f" AND {proximity._in_time(here[2], there[2], seconds, direction)}"
    )
