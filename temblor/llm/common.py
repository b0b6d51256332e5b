"""What several operators share: scratch tables, checked broadcasts, words and hashes in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.config import shared_dir

BROADCAST_ROWS = 200_000

# Words of the two word rules, as the separators between them (upper case is lowered separately).
ALNUM_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

_RADIX = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240917)).integers(1, 2**64 - 1, 256, np.uint64)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: lost executors don't repeat what led here."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table, counted now, has at most `rows` rows; else leave it shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def alnum_words(text: Column) -> Column:
    """Array of the lower-cased words of ASCII letters, digits and all non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_GAP), "")


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array, and the n+1 offsets of its rows; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch, most: int = 4 << 20):
    """Cut a record batch into runs of rows with about `most` bytes of text (one row at least)."""
    _, offsets = text_bytes(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def space_words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of the runs without ASCII white space; no word crosses rows."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.empty(len(data) + 1, bool)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~gap
    edge[0], edge[-1] = word[0], False
    edge[1:-1] = word[1:] & gap[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    edge[inner] |= word[inner]
    starts = np.flatnonzero(edge[:-1])
    stop = np.empty(len(data) + 1, bool)
    stop[0], stop[-1] = False, word[-1]
    stop[1:-1] = word[:-1] & gap[1:]
    stop[inner] |= word[inner - 1]
    ends = np.flatnonzero(stop)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z of UTF-8 bytes."""
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data | 32, data)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
        have += take
    return out


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal runs get equal values wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_TABLE[data] * _powers(_RADIX, len(data)), out=total[1:])
    back = _powers(pow(_RADIX, -1, 1 << 64), len(data) + 1)
    length = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * back[starts] + length * np.uint64(0xD6E8FEB86659FD93))
