"""Calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.timeutil import as_ntz


def calendar_columns(time_col: str = "time", tz: str | None = None) -> dict:
    """hour, day, month, day_of_week (Monday=0) and is_weekend, all int.

    Times are read as UTC wall clock (the reference's choice); ``tz`` shifts to a
    site time zone first.
    """
    t = as_ntz(time_col)
    if tz:
        t = F.from_utc_timestamp(t.cast("timestamp"), tz).cast("timestamp_ntz")
    dow = F.weekday(t)
    return {
        "hour": F.hour(t).cast("int"),
        "day": F.dayofmonth(t).cast("int"),
        "month": F.month(t).cast("int"),
        "day_of_week": dow.cast("int"),
        "is_weekend": (dow >= 5).cast("int"),
    }


def add_calendar(df: DataFrame, time_col: str = "time", tz: str | None = None) -> DataFrame:
    return df.withColumns(calendar_columns(time_col, tz))
