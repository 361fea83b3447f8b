"""Registered queries: history tail, as-of lags, interval stats, forecast feature rows (§2.3 J3/J4, W5, O2)."""

from __future__ import annotations

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS
from aerolith.operators import features, joins
from aerolith.operators import forecast as FC
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx
from aerolith.sources.fixtures import WEATHER_RAW_COLUMNS

_LAGS = [f"{p}_lag_{k}h" for p in POLLUTANTS for k in LAG_HOURS]
_ROLLS = [f"{p}_roll_{s}_{n}h" for p in POLLUTANTS for n in ROLL_HOURS for s in ("mean", "std")]

_HIST = f"""hist AS (
  SELECT station, time, {', '.join(POLLUTANTS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY station ORDER BY time DESC) AS rn FROM feat_full) WHERE rn <= 48)"""
_FUT = "fut AS (SELECT *, " + ", ".join(f"time - INTERVAL {k} HOUR AS t{k}" for k in LAG_HOURS) + " FROM future)"
_ASOF = "asof_l AS (SELECT f.station, f.time, " + ", ".join(
    f"l{k}.{p} AS {p}_lag_{k}h" for p in POLLUTANTS for k in LAG_HOURS) + " FROM fut f " + " ".join(
    f"ASOF LEFT JOIN hist l{k} ON f.station = l{k}.station AND f.t{k} >= l{k}.time" for k in LAG_HOURS) + ")"


def _roll_exprs() -> list[str]:
    out = []
    for p in POLLUTANTS:
        for n in ROLL_HOURS:
            cond = f"h.time >= f.time - INTERVAL {n} HOUR"
            out.append(f"avg(h.{p}) FILTER (WHERE {cond}) AS {p}_roll_mean_{n}h")
            out.append(f"CASE WHEN count(h.time) FILTER (WHERE {cond}) > 1 "
                       f"THEN stddev_samp(h.{p}) FILTER (WHERE {cond}) ELSE 0 END AS {p}_roll_std_{n}h")
    return out


_ROLL = f"""rolls AS (
  SELECT f.station, f.time, {', '.join(_roll_exprs())}
  FROM future f LEFT JOIN hist h
    ON h.station = f.station AND h.time >= f.time - INTERVAL {max(ROLL_HOURS)} HOUR AND h.time < f.time
  GROUP BY f.station, f.time)"""

_CTES = S.features_ctes(S.future_cte(), _HIST, _FUT, _ASOF, _ROLL, forecast=True)


def inputs(spark, sf_dir):
    """(history, future): the last rows of each station before the forecast time, and the weather hours after it, from one landed table."""
    air, weather = fx.landed(spark, sf_dir, fx.as_of(spark, sf_dir))
    return FC.history_tail(features.build_features(air, weather, strategy="auto")), joins.anti_join_time(weather, air, ["station"])


def inputs_of(table, air, weather, as_of):
    """``inputs`` from the feature table of all hours and the air and weather that it was built from.

    Features look back only, so the table's rows before the forecast time are those of the air readings before it.  Stations with readings without a
    time are built again: these come first in a station and fill its first gaps, but no forecast has them.
    """
    columns = ["station", "time", *POLLUTANTS]
    history, past = fx.air_before(table, as_of).select(*columns), fx.air_before(air, as_of)
    undated = air.where("time IS NULL").select("station").distinct()
    if not undated.isEmpty():
        own = [t.join(undated, "station", "left_semi") for t in (past, weather)]
        history = history.join(undated, "station", "left_anti").unionByName(features.build_features(*own, strategy="auto").select(*columns))
    return FC.history_tail(history), joins.anti_join_time(weather, past, ["station"])


@query("history_tail", sql=f"""{S.features_ctes(_HIST, forecast=True)}
SELECT station, time, {S.rounded_select(POLLUTANTS, [])} FROM hist""")
def history_tail(spark, sf_dir):
    """O2: the last 48 feature rows per station (lag context of the forecast)."""
    return round_doubles(inputs(spark, sf_dir)[0].select("station", "time", *POLLUTANTS))


@query("asof_lag", sql=f"""{_CTES}
SELECT station, time, {S.rounded_select(_LAGS, [])} FROM asof_l""")
def asof_lag(spark, sf_dir):
    """Per future hour and lag k, the reading of the last history row at or before t - k hours."""
    history, future = inputs(spark, sf_dir)
    f = FC.forecast_features(history, future.select("station", "time"),
                             include_rolling=False, include_calendar=False)
    return round_doubles(f)


@query("interval_join_stats", sql=f"""{_CTES}
SELECT station, time, {S.rounded_select(_ROLLS, [])} FROM rolls""")
def interval_join_stats(spark, sf_dir):
    """mean/std over history rows in [t - 6 h, t) and [t - 24 h, t) per future hour."""
    history, future = inputs(spark, sf_dir)
    f = FC.forecast_features(history, future.select("station", "time"),
                             include_lags=False, include_calendar=False)
    return round_doubles(f)


@query("forecast_features", sql=f"""{_CTES}
SELECT station, time, {S.calendar_select()}, {S.rounded_select(WEATHER_RAW_COLUMNS + _LAGS + _ROLLS, [])}
FROM future JOIN asof_l USING (station, time) JOIN rolls USING (station, time)""")
def forecast_features(spark, sf_dir):
    """W5 + J3 + F1/F2: the full feature row of every future hour (weather, calendar, lags, rolling)."""
    return round_doubles(FC.forecast_features(*inputs(spark, sf_dir)))
