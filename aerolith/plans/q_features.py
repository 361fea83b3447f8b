"""Registered queries: cleaning, joins, calendar, lag/rolling features (§2.2, §2.3, §2.5)."""

from __future__ import annotations

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS
from aerolith.functions.calendar import add_calendar
from aerolith.operators import clean, features, joins, windows
from aerolith.plans import base
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx
from aerolith.sources.fixtures import AIR_COLUMNS, WEATHER_RAW_COLUMNS

_DOUBLES, _INTS = S.feature_columns()


@query("features_full", sql=f"""{S.merged_ctes(S.engineered_cte())}
SELECT {S.rounded_select(_DOUBLES, ['station', 'time', *_INTS])}
FROM feat WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _DOUBLES + _INTS)}""")
def features_full(spark, sf_dir):
    """Flagship: air and weather cleaned, joined, calendar + 20 lags + 20 rolling stats, dropna (P10)."""
    return round_doubles(base.feature_table(spark, sf_dir))


@query("join_air_weather", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(AIR_COLUMNS + WEATHER_RAW_COLUMNS, [])}
FROM air JOIN weather USING (station, time)""")
def join_air_weather(spark, sf_dir):
    """Inner equi-join of raw air and weather on (station, time)."""
    return round_doubles(joins.join_on_time(fx.air(spark, sf_dir), fx.weather(spark, sf_dir)))


@query("future_weather", sql=f"""{S.base_ctes(S.future_cte(), forecast=True)}
SELECT station, time, {S.rounded_select(WEATHER_RAW_COLUMNS, [])} FROM future""")
def future_weather(spark, sf_dir):
    """Weather hours without an air row (the forecast hours)."""
    return round_doubles(fx.future_weather(spark, sf_dir))


@query("drop_all_null", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(WEATHER_RAW_COLUMNS, [])}, {S.r6('pm2_5', 'pm2_5')}, {S.r6('pm10', 'pm10')}
FROM weather LEFT JOIN (SELECT station, time, pm2_5, pm10 FROM air) a USING (station, time)
WHERE NOT (pm2_5 IS NULL AND pm10 IS NULL)""")
def drop_all_null(spark, sf_dir):
    """Weather left-joined with air PM; hours where both PM readings are missing are dropped."""
    a = fx.air(spark, sf_dir).select("station", "time", "pm2_5", "pm10")
    df = joins.join_on_time(fx.weather(spark, sf_dir), a, how="left")
    return round_doubles(clean.drop_all_null(df, subset=["pm2_5", "pm10"]))


@query("drop_any_subset", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(AIR_COLUMNS + WEATHER_RAW_COLUMNS, [])}
FROM air JOIN weather USING (station, time) WHERE pm2_5 IS NOT NULL AND pm10 IS NOT NULL""")
def drop_any_subset(spark, sf_dir):
    """Joined rows with PM2.5 and PM10 both present (the hourly fetch's filter)."""
    df = joins.join_on_time(fx.air(spark, sf_dir), fx.weather(spark, sf_dir))
    return round_doubles(clean.drop_any_null(df, subset=["pm2_5", "pm10"]))


@query("ffill", sql=f"""{S.base_ctes(S.clean_cte('air_c', 'air', AIR_COLUMNS))}
SELECT station, time, {S.rounded_select(AIR_COLUMNS, [])} FROM air_c""")
def ffill(spark, sf_dir):
    """Drop all-missing hours, then forward fill every air column per station (skew-safe carry fill)."""
    return round_doubles(features.clean_readings(fx.air(spark, sf_dir), strategy="blocked"))


@query("calendar_features", sql=f"""{S.base_ctes()}
SELECT station, time, {S.calendar_select()} FROM weather""")
def calendar_features(spark, sf_dir):
    """Hour, day, month, weekday (Mon=0), weekend flag of every weather hour."""
    return add_calendar(fx.weather(spark, sf_dir).select("station", "time"))


_LAGS = [f"{c}_lag_{k}h" for c in POLLUTANTS for k in LAG_HOURS]
_ROLLS = [f"{c}_roll_{s}_{n}h" for c in POLLUTANTS for n in ROLL_HOURS for s in ("mean", "std")]


@query("lag_features", sql=f"""{S.base_ctes()},
lagged AS (SELECT station, time, {', '.join(S.lag_select())} FROM air)
SELECT station, time, {S.rounded_select(_LAGS, [])} FROM lagged""")
def lag_features(spark, sf_dir):
    """Row lags 1, 2, 6, 24 of the five pollutants on raw air (NULLs kept)."""
    a = fx.air(spark, sf_dir).select("station", "time", *POLLUTANTS)
    return round_doubles(windows.lag_features(a).drop(*POLLUTANTS))


@query("rolling_features", sql=f"""{S.base_ctes()},
rolled AS (SELECT station, time, {', '.join(S.rolling_select())} FROM air)
SELECT station, time, {S.rounded_select(_ROLLS, [])} FROM rolled""")
def rolling_features(spark, sf_dir):
    """Mean and std of the previous 6 and 24 rows on raw air (NULLs skipped)."""
    a = fx.air(spark, sf_dir).select("station", "time", *POLLUTANTS)
    return round_doubles(windows.rolling_features(a).drop(*POLLUTANTS))
