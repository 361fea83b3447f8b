"""Row-ordered window operators: lags (W1), rolling mean/std (W2, W3), forward fill.

``strategy``:
* ``"blocked"`` (default): skew-safe halo / carry evaluation (``aerolith.operators.scale``);
  each task holds a bounded block of one key.
* ``"plain"``: one ``Window.partitionBy(keys)``; fine when every key is provably small
  (e.g. a few years of one station's hours).
* ``"auto"``: the rows of the longest key are counted (one aggregate over ``df``); up to ``scale.PLAIN_ROWS`` the plain window, beyond it blocks.
All give identical results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS
from aerolith.operators import scale


def q(name: str) -> str:
    return f"`{name}`"


def over(keys: Sequence[str], order: Sequence[str]) -> str:
    """SQL window clause body ``PARTITION BY keys ORDER BY order``.

    Window columns are built as SQL text (``F.expr``): one driver-to-JVM call per
    column instead of one per expression node, which dominates planning time for the
    40 lag/rolling columns.  The plan is identical.
    """
    part = f"PARTITION BY {', '.join(q(k) for k in keys)} " if keys else ""
    return f"{part}ORDER BY {', '.join(q(o) for o in order)}"


def ordered(keys: Sequence[str], time_col: str = "time", tiebreak: Sequence[str] = ()) -> str:
    return over(keys, [time_col, *tiebreak])


def lag_columns(w: str, cols: Sequence[str] = POLLUTANTS, lags: Sequence[int] = LAG_HOURS) -> dict[str, Column]:
    """``shift(k)``: the value ``k`` rows earlier (a row shift, not an hour shift)."""
    return {f"{c}_lag_{k}h": F.expr(f"lag({q(c)}, {k}) OVER ({w})") for c in cols for k in lags}


def rolling_columns(w: str, cols: Sequence[str] = POLLUTANTS,
                    widths: Sequence[int] = ROLL_HOURS) -> dict[str, Column]:
    """``shift(1).rolling(n, min_periods=1)`` mean and ``std().fillna(0)``.

    Frame = the ``n`` rows before the current one.  NULLs are skipped; no value ->
    mean NULL; fewer than two values -> std 0.0.
    """
    out = {}
    for c in cols:
        for n in widths:
            f = f"OVER ({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            out[f"{c}_roll_mean_{n}h"] = F.expr(f"avg({q(c)}) {f}")
            out[f"{c}_roll_std_{n}h"] = F.expr(f"coalesce(stddev_samp({q(c)}) {f}, CAST(0 AS DOUBLE))")
    return out


def chosen(strategy: str, df: DataFrame, keys: Sequence[str]) -> str:
    """``strategy``, with ``"auto"`` decided by the rows of the longest key."""
    if strategy != "auto":
        return strategy
    return "plain" if keys and scale.longest_series(df, keys) <= scale.PLAIN_ROWS else "blocked"


def _apply(df: DataFrame, keys, build, reach: int, time_col: str, tiebreak, strategy: str, **kw) -> DataFrame:
    strategy = chosen(strategy, df, keys)
    if strategy == "plain":
        return df.withColumns(build(ordered(keys, time_col, tiebreak)))
    if strategy == "blocked":
        return scale.halo_window(df, keys, build, reach, time_col, tiebreak, **kw)
    raise ValueError(f"unknown strategy {strategy!r}")


def lag_features(df: DataFrame, cols: Sequence[str] = POLLUTANTS, lags: Sequence[int] = LAG_HOURS,
                 keys: Sequence[str] = ("station",), time_col: str = "time", tiebreak: Sequence[str] = (),
                 strategy: str = "blocked", **kw) -> DataFrame:
    return _apply(df, list(keys), lambda w: lag_columns(w, cols, lags), max(lags), time_col, tiebreak, strategy, **kw)


def rolling_features(df: DataFrame, cols: Sequence[str] = POLLUTANTS, widths: Sequence[int] = ROLL_HOURS,
                     keys: Sequence[str] = ("station",), time_col: str = "time", tiebreak: Sequence[str] = (),
                     strategy: str = "blocked", **kw) -> DataFrame:
    return _apply(df, list(keys), lambda w: rolling_columns(w, cols, widths), max(widths), time_col, tiebreak,
                  strategy, **kw)


def lag_and_rolling(df: DataFrame, cols: Sequence[str] = POLLUTANTS, lags: Sequence[int] = LAG_HOURS,
                    widths: Sequence[int] = ROLL_HOURS, keys: Sequence[str] = ("station",), time_col: str = "time",
                    tiebreak: Sequence[str] = (), strategy: str = "blocked", **kw) -> DataFrame:
    """W1-W3 in one pass: all frames share one ordering, so Spark sorts once."""
    def build(w):
        return {**lag_columns(w, cols, lags), **rolling_columns(w, cols, widths)}
    return _apply(df, list(keys), build, max([*lags, *widths]), time_col, tiebreak, strategy, **kw)


def ffill(df: DataFrame, cols: Sequence[str] | None = None, keys: Sequence[str] = ("station",),
          time_col: str = "time", tiebreak: Sequence[str] = (), strategy: str = "blocked", **kw) -> DataFrame:
    """Forward fill (W4): last non-null at or before each row; leading NULLs stay."""
    keys = list(keys)
    if cols is None:
        cols = [c for c in df.columns if c not in keys and c != time_col and c not in tiebreak]
    strategy = chosen(strategy, df, keys)
    if strategy == "plain":
        w = f"OVER ({ordered(keys, time_col, tiebreak)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return df.withColumns({c: F.expr(f"last({q(c)}, true) {w}") for c in cols})
    if strategy == "blocked":
        return scale.carry_fill(df, keys, cols, time_col, tiebreak, **kw)
    raise ValueError(f"unknown strategy {strategy!r}")
