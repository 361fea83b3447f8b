"""Forecast feature rows for future hours.

For every future hour ``t`` of a key:

* ``<pol>_lag_<k>h``: value of the last history row with ``time <= t - k hours``
  (as-of backward lookup; a NULL reading there is the answer, not skipped);
* ``<pol>_roll_mean_<n>h`` / ``_std_``: over history rows with ``t - n h <= time < t``;
  mean NULL when no row, std 0.0 when at most one *row* (NULL readings count as rows).

History and future rows are unioned per key and both lookups become range frames over
epoch microseconds on one ordering, so one sort serves all 40 columns.  The history
is the last ``HISTORY_CONTEXT_ROWS`` rows of each key (``history_tail``), so each key's
partition holds at most 48 + horizon rows: bounded however large the store is.
The forecast is not autoregressive (D4): lags freeze at the last known value and the
rolling frames empty out after 6/24 hours, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.config import HISTORY_CONTEXT_ROWS, LAG_HOURS, POLLUTANTS, ROLL_HOURS
from aerolith.functions.calendar import calendar_columns
from aerolith.functions.timeutil import HOUR_US, epoch_micros

_T = "__t_us"
_H = "__is_hist"


def history_tail(df: DataFrame, n: int = HISTORY_CONTEXT_ROWS, keys: Sequence[str] = ("station",),
                 time_col: str = "time") -> DataFrame:
    """Last ``n`` rows per key by time (O2).  Planned as a per-partition top-k
    (``WindowGroupLimit``) before the shuffle, so only ``n`` rows per key and task move."""
    w = Window.partitionBy(*keys).orderBy(F.col(time_col).desc())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def _union(history: DataFrame, future: DataFrame, keys, time_col, pollutants) -> DataFrame:
    """History and future rows in one frame; each side's missing columns are NULL.
    Future columns ride along, so no join back is needed after the windows."""
    h = history.select(*keys, time_col, *[F.col(p).cast("double") for p in pollutants]).withColumn(_H, F.lit(True))
    fcols = [c for c in future.columns if c not in (*keys, time_col) and c not in pollutants]
    f = future.select(*keys, time_col, *fcols).withColumn(_H, F.lit(False))
    u = h.unionByName(f, allowMissingColumns=True)
    return u.withColumn(_T, epoch_micros(time_col)), fcols


def asof_lag_columns(w: str, pollutants: Sequence[str] = POLLUTANTS, lags: Sequence[int] = LAG_HOURS) -> dict:
    """J3 as range frames: last history struct in (-inf, t - k h] (SQL text, one JVM call per column)."""
    out = {}
    fields = ", ".join(f"`{p}`" for p in pollutants)
    for k in lags:
        frame = f"OVER ({w} RANGE BETWEEN UNBOUNDED PRECEDING AND {k * HOUR_US} PRECEDING)"
        last = f"last(CASE WHEN {_H} THEN struct({fields}) END, true) {frame}"
        for p in pollutants:
            out[f"{p}_lag_{k}h"] = F.expr(f"({last}).`{p}`")
    return out


def interval_stat_columns(w: str, pollutants: Sequence[str] = POLLUTANTS, widths: Sequence[int] = ROLL_HOURS) -> dict:
    """Mean and std over history rows in [t - n h, t)."""
    out = {}
    for p in pollutants:
        for n in widths:
            frame = f"OVER ({w} RANGE BETWEEN {n * HOUR_US} PRECEDING AND 1 PRECEDING)"
            v = f"CASE WHEN {_H} THEN `{p}` END"
            rows = f"count(CASE WHEN {_H} THEN 1 END) {frame}"
            out[f"{p}_roll_mean_{n}h"] = F.expr(f"avg({v}) {frame}")
            out[f"{p}_roll_std_{n}h"] = F.expr(
                f"CASE WHEN {rows} > 1 THEN stddev_samp({v}) {frame} ELSE CAST(0 AS DOUBLE) END")
    return out


def forecast_features(history: DataFrame, future: DataFrame, keys: Sequence[str] = ("station",),
                      time_col: str = "time", pollutants: Sequence[str] = POLLUTANTS,
                      lags: Sequence[int] = LAG_HOURS, widths: Sequence[int] = ROLL_HOURS,
                      include_lags: bool = True, include_rolling: bool = True,
                      include_calendar: bool = True) -> DataFrame:
    """Feature rows for the ``future`` hours from the ``history`` rows (already tailed)."""
    keys = list(keys)
    u, fcols = _union(history, future, keys, time_col, pollutants)
    w = (f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else "") + f"ORDER BY {_T}"
    cols = {}
    if include_lags:
        cols.update(asof_lag_columns(w, pollutants, lags))
    if include_rolling:
        cols.update(interval_stat_columns(w, pollutants, widths))
    if include_calendar:
        cols.update(calendar_columns(time_col))
    return u.withColumns(cols).where(~F.col(_H)).select(*keys, time_col, *fcols, *cols.keys())
