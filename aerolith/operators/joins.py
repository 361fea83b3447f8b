"""Joins on the time key.

Both are equi-joins on ``keys + [time]``: Spark hashes both sides on the full key
(station *and* hour), so a hot station spreads over all its hours.  No broadcast
hint: both sides grow with the data; AQE switches to a broadcast join at run time
when one side is measured small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_on_time(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                 how: str = "inner") -> DataFrame:
    """``pd.merge(left, right, on='time', how='inner')`` per key.

    Keys are plain equality (pandas would match missing keys with each other; the
    keys here are never missing).  Duplicated keys multiply as in pandas.
    """
    return left.join(right, [*keys, time_col], how)


def anti_join_time(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("station",),
                   time_col: str = "time") -> DataFrame:
    """Rows of ``left`` whose (key, time) is absent from ``right``."""
    return left.join(right.select(*keys, time_col), [*keys, time_col], "left_anti")
