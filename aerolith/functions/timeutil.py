"""Time helpers as Column expressions.

All helpers work on ``timestamp_ntz`` without consulting the session time zone,
so results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
_EPOCH = "1970-01-01 00:00:00"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ntz(c) -> Column:
    """Any timestamp column as timestamp_ntz."""
    return col(c).cast("timestamp_ntz")


def ntz_lit(value) -> Column:
    """A timestamp_ntz literal from a ``datetime`` or an ISO string (no zone conversion)."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz (zone free)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), as_ntz(c))


def epoch_hours(c) -> Column:
    """Whole hours since 1970-01-01 (floor) of a timestamp_ntz."""
    return F.floor(epoch_micros(c) / F.lit(HOUR_US)).cast("bigint")


def hour_floor(c) -> Column:
    """Truncate to the hour (``date_trunc('hour', ts)``) on timestamp_ntz."""
    t = as_ntz(c)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def from_epoch_seconds(c) -> Column:
    """Epoch seconds -> timestamp_ntz in UTC."""
    return F.timestamp_add("SECOND", col(c), _epoch())


def hourly_range(start, end, step_seconds) -> Column:
    """``date_range(start, end, freq=step, inclusive='left')`` (F6) as an array column.

    ``start``/``end``/``step_seconds`` are epoch-second columns; an empty range
    (end <= start) yields an empty array instead of an error.
    """
    s, e, st = col(start), col(end), col(step_seconds)
    n = F.ceil((e - s) / st).cast("int")
    seq = F.transform(F.sequence(F.lit(0), n - 1), lambda i: from_epoch_seconds(s + i.cast("bigint") * st))
    return F.when(e > s, seq).otherwise(F.array().cast("array<timestamp_ntz>"))
