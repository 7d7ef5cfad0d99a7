"""Joins whose small side is broadcast only behind a checked bound."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side never has more rows than this; a row here is a few keys and
# numbers, so the limit is some tens of megabytes per executor.
BROADCAST_ROWS = 500_000

_counted: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when at most ``rows`` rows can occur and that is few enough.

    Beyond the limit the frame is returned as it is: Catalyst then shuffles
    both sides and AQE splits a skewed partition.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def measured_side(df: DataFrame) -> DataFrame:
    """Count the rows first, then decide. For small control tables beside heavy ones."""
    return small_side(df, df.count())


def calendar_rows(races: DataFrame) -> int:
    """Number of races on the calendar, read from file metadata for a written table.

    Rounds stop at 99 in a season, so this grows with years and never with the
    number of results, laps or drivers. Counted once per frame.
    """
    if races not in _counted:
        _counted[races] = races.count()
    return _counted[races]


def spine_left_join(spine: DataFrame, df: DataFrame, keys: list[str], zero: tuple[str, ...] = ()) -> DataFrame:
    """Keep every spine row; measures named in ``zero`` become 0 where nothing matched."""
    joined = spine.join(df, keys, "left")
    return joined.fillna(0, list(zero)) if zero else joined
