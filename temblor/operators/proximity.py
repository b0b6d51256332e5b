"""Joining events that lie close together in space and time.

Expressions are written as SQL text: one call to the JVM each, where building them from Column
objects took longer than running the join on a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.operators.skew import TILES, expand_copies, tile_hot_keys

CELL = ("cell_lat", "cell_lon", "cell_time")

# The reach of a box is widened by this much when cells are chosen, because the exact test
# subtracts in the columns' own type and a float difference may round down onto the limit.
REACH_MARGIN = 1e-5

# Areas used for pruning are folded onto this many values, whatever the coordinates hold.
AREA_ROWS, AREA_COLUMNS = 1024, 2048


def proximity_join(
    left: DataFrame,
    right: DataFrame,
    box: float = 0.1,
    seconds: int = 900,
    direction: str = "both",
    *,
    suffixes: tuple[str, str] = ("_left", "_right"),
    equal: tuple[str, str] | None = None,
    hot_rows: int = 20_000,
    copies: bool = True,
) -> DataFrame:
    """Inner join on |latitude| and |longitude| differences <= `box` and on time.

    `direction`, with d = whole seconds from left to right:
      both    the moments differ and |d| <= seconds
      after   0 < d <= seconds
      before  0 < -d <= seconds
      later   the right moment is later, by any fraction of a second, and d <= seconds

    With `equal`, a column of each side, those two have to be equal as well.

    Both sides need `latitude`, `longitude` and `date`; every column comes out with its side's
    suffix. Rows with a NULL or non-finite position or a NULL date match nothing.

    The plan is an equi-join on grid cells followed by the exact test. Cells are at least twice
    as wide as the reach, so a left row's box meets one or two cells per dimension (1.8 x 1.8 in
    space at the defaults, two in time at most) and is copied only to those; each right row has
    one cell, so a pair meets once. Cells holding more than `hot_rows` rows of a side are split,
    which repeats l left rows r / hot_rows times and the other way round: the shuffle of a dense
    cell is quadratic like its pairs, but over `hot_rows`. Exact copies of rows in such cells are
    merged for the join and dealt out again after it; `copies=False` leaves that out, for inputs
    without copies. Make the smaller side the left one.
    """
    a, b = (
        _located(df).toDF(*[name + suffix for name in df.columns])
        for df, suffix in zip((left, right), suffixes)
    )
    (lat_a, lon_a, date_a), (lat_b, lon_b, date_b) = (
        [f"`{name}{suffix}`" for name in ("latitude", "longitude", "date")] for suffix in suffixes
    )
    reach = box + REACH_MARGIN
    width = cell_width(reach)
    back, ahead = _time_reach(direction, seconds)
    span = 2 * (seconds + 1)

    a = _areas_met(a, lat_a, lon_a, reach, width).selectExpr(
        "*", f"{_cells_met(_second(date_a), back, ahead, span)} AS cell_time"
    )
    b = b.selectExpr(
        "*",
        f"{_cell(lat_b, width)} AS cell_lat",
        f"{_cell(lon_b, width)} AS cell_lon",
        f"{_cell(_second(date_b), span)} AS cell_time",
    )
    keys = list(CELL)
    if equal:
        a, b = (
            df.selectExpr("*", f"`{name}{suffix}` AS equal")
            for df, name, suffix in zip((a, b), equal, suffixes)
        )
        keys.append("equal")
    a, b = tile_hot_keys(a, b, keys, hot_rows, copies)
    keys += TILES
    exact = (
        f"{lat_a} - {lat_b} BETWEEN -{float(box)}D AND {float(box)}D"
        f" AND {lon_a} - {lon_b} BETWEEN -{float(box)}D AND {float(box)}D"
        f" AND {_in_time(date_a, date_b, seconds, direction)}"
    )
    # The exact test follows the join as a filter; Catalyst folds it into the join condition.
    pairs = a.join(b, keys).where(exact).drop(*keys)
    return expand_copies(pairs) if copies else pairs


def within_reach(df: DataFrame, of: DataFrame, box: float = 0.1) -> DataFrame:
    """Drop rows of `df` in areas that no row of `of` comes near; keep a superset of the rest.

    A reduction ahead of `proximity_join`, before anything is shuffled: it pays where `of` is a
    rare kind of event. The list of areas is broadcast. Areas are folded onto
    AREA_ROWS x AREA_COLUMNS numbers, which bounds the list whatever the data holds.
    """
    reach = box + REACH_MARGIN
    width = cell_width(reach)
    areas = (
        _areas_met(_located(of), "latitude", "longitude", reach, width)
        .selectExpr(f"{_area('cell_lat', 'cell_lon')} AS area")
        .distinct()
    )
    own = F.expr(_area(_cell("latitude", width), _cell("longitude", width)))
    return _located(df).join(F.broadcast(areas), own == areas["area"], "left_semi")


def cell_width(reach: float) -> float:
    """The smallest power of two that is at least twice `reach` (division by it is exact)."""
    width = 2.0**-20
    while width < 2 * reach:
        width *= 2
    return width


def _located(df: DataFrame) -> DataFrame:
    """Rows that can match. Spark orders NaN above infinity, so one test excludes both."""
    return df.where(
        "abs(latitude) < double('infinity') AND abs(longitude) < double('infinity')"
        " AND date IS NOT NULL"
    )


def _second(date: str) -> str:
    return f"unix_timestamp({date})"


def _cell(value: str, width: float) -> str:
    """Cell number of a position or second that is known not to be NULL.

    Saying so with coalesce keeps Catalyst from adding IS NOT NULL tests on the join side only,
    after which the join and the pass that looks for hot cells could no longer share a shuffle.
    """
    return f"coalesce(floor(CAST({value} AS DOUBLE) / {float(width)}D), 0L)"


def _cells_met(value: str, back: float, ahead: float, width: float) -> str:
    """A row per cell from `value - back` to `value + ahead`, at most one cell width apart."""
    low = _cell(f"({value} - {float(back)}D)", width)
    high = _cell(f"({value} + {float(ahead)}D)", width)
    return f"explode(CASE WHEN {low} = {high} THEN array({low}) ELSE array({low}, {high}) END)"


def _areas_met(df: DataFrame, lat: str, lon: str, reach: float, width: float) -> DataFrame:
    """A row per spatial cell that the box around a point meets."""
    df = df.selectExpr("*", f"{_cells_met(lat, reach, reach, width)} AS cell_lat")
    return df.selectExpr("*", f"{_cells_met(lon, reach, reach, width)} AS cell_lon")


def _area(cell_lat: str, cell_lon: str) -> str:
    return f"pmod({cell_lat}, {AREA_ROWS}L) * {AREA_COLUMNS}L + pmod({cell_lon}, {AREA_COLUMNS}L)"


def _time_reach(direction: str, seconds: int) -> tuple[int, int]:
    """How far back and ahead of a left row a matching right row can lie."""
    reaches = {
        "both": (seconds, seconds),
        "after": (0, seconds),
        "later": (0, seconds),
        "before": (seconds, 0),
    }
    if direction not in reaches:
        raise ValueError(f"direction must be one of {sorted(reaches)}, not {direction!r}")
    return reaches[direction]


def _in_time(date_a: str, date_b: str, seconds: int, direction: str) -> str:
    elapsed = f"{_second(date_b)} - {_second(date_a)}"
    return {
        "both": f"{date_a} <> {date_b} AND abs({elapsed}) <= {seconds}",
        "after": f"{elapsed} BETWEEN 1 AND {seconds}",
        "before": f"{elapsed} BETWEEN -{seconds} AND -1",
        "later": f"{date_b} > {date_a} AND {elapsed} <= {seconds}",
    }[direction]
