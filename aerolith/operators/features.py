"""Historical feature table: clean -> join -> calendar -> lags -> rolling -> dropna.

One lazy plan from the raw hourly readings to the 51-feature table; Spark shares the
sort of one window ordering among all lag and rolling columns.

Partitioning: the inputs are hourly grain, one row per (station, hour), because they
come out of a ``groupBy(station, hour)`` (or a keyed store), so a window per station holds at
most one row per hour of the time span (8,760 a year).  ``strategy="auto"`` counts the rows of the longest series first and takes
rank blocks of a bounded number of rows (``operators.scale``) where a series is longer than ``scale.PLAIN_ROWS``, as raw
sub-hourly readings or one series without keys may be; ``"plain"`` and ``"blocked"`` fix the choice.  The results are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS
from aerolith.functions.calendar import add_calendar
from aerolith.operators.clean import drop_all_null, drop_any_null, nan_to_null
from aerolith.operators.joins import join_on_time
from aerolith.operators.windows import chosen, ffill, lag_and_rolling


def clean_readings(df: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                   strategy: str = "plain") -> DataFrame:
    """Drop hours with no reading at all, then forward fill the gaps (clean step)."""
    keys = list(keys)
    df = nan_to_null(df)
    df = drop_all_null(df, exclude=[*keys, time_col])
    return ffill(df, keys=keys, time_col=time_col, strategy=strategy)


def merge_clean(air: DataFrame, weather: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                strategy: str = "plain") -> DataFrame:
    """Cleaned air inner-joined with cleaned weather on (keys, time)."""
    return join_on_time(clean_readings(air, keys, time_col, strategy), clean_readings(weather, keys, time_col, strategy),
                        keys, time_col)


def engineer(df: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
             pollutants: Sequence[str] = POLLUTANTS, lags: Sequence[int] = LAG_HOURS,
             widths: Sequence[int] = ROLL_HOURS, strategy: str = "plain") -> DataFrame:
    """Calendar, lag and rolling features on a merged hourly table (no row dropped)."""
    df = add_calendar(df, time_col)
    return lag_and_rolling(df, pollutants, lags, widths, keys, time_col, strategy=strategy)


def build_features(air: DataFrame, weather: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                   strategy: str = "plain", dropna_subset: Sequence[str] | None = None) -> DataFrame:
    """The full historical feature table; rows with any missing value are dropped (P10)."""
    if strategy == "auto":  # an inner join on (keys, time) of keyed rows has no longer series than its sides
        strategy = chosen("auto", air.select(*keys).unionByName(weather.select(*keys)), list(keys))
    merged = merge_clean(air, weather, keys, time_col, strategy)
    return drop_any_null(engineer(merged, keys, time_col, strategy=strategy), dropna_subset)
