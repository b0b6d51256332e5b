"""Reading what streams have written."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(stored: DataFrame, identity: Sequence[str] = ("origin",)) -> DataFrame:
    """Stored rows, each once.

    A sink that cannot take rows back may hold a batch twice after a failure. Rows of a stream
    that are not replaced by newer ones are told apart by their message's origin.
    """
    return stored.dropDuplicates(list(identity))


def latest_view(
    changelog: DataFrame, keys: Sequence[str] = ("start", "end"), order: str = "batch_id"
) -> DataFrame:
    """One row per key: the one written last.

    An update-mode stream writes a row each time a window changes; this is the table those
    writes amount to. A batch written twice carries the same values twice and has no effect.
    """
    return compacted(changelog, keys, order).drop(order)


def compacted(
    changelog: DataFrame, keys: Sequence[str] = ("start", "end"), order: str = "batch_id"
) -> DataFrame:
    """The changelog without rows that were replaced; write it in place of the batches it covers.

    One aggregate per column, so that fixed-width values are aggregated by hash.
    """
    values = [c for c in changelog.columns if c not in (*keys, order)]
    newest = [F.max_by(c, order).alias(c) for c in values]
    return changelog.groupBy(*keys).agg(*newest, F.max(order).alias(order))
