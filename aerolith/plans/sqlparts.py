"""ANSI-SQL building blocks of the DuckDB twins (stand-in tables and feature frames).

The strings mirror ``aerolith.sources.fixtures`` and ``aerolith.operators.features``
definition by definition, so every twin query is ``WITH <parts> SELECT ...``.
"""

from __future__ import annotations

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS, WEATHER_COLS
from aerolith.sources.fixtures import AIR_COLUMNS, FORECAST_DAYS, TYPE_TO_POLLUTANT, WEATHER_RAW_COLUMNS

#: The forecast time, from the data itself.
AS_OF_SQL = f"(SELECT date_trunc('day', max(ts)) - INTERVAL {FORECAST_DAYS} DAY FROM events)"
W = "PARTITION BY station ORDER BY time"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def q6(expr: str) -> str:
    """Same 1e-6 grid as ``aerolith.plans.common.quantize`` (identical IEEE steps)."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"CASE WHEN isnan({x}) OR isinf({x}) THEN {x} ELSE "
            f"floor({x} * CAST(1000000 AS DOUBLE) + CAST(0.4999 AS DOUBLE)) / CAST(1000000 AS DOUBLE) END")


def r6(expr: str, alias: str) -> str:
    return f"{q6(expr)} AS {alias}"


def ev_cte() -> str:
    return """ev AS (
  SELECT user_id AS station, date_trunc('hour', ts) AS time, ts, event_type,
         CAST(round(value * 100) AS BIGINT) AS c,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""


def _mean_cents(cond: str | None = None) -> str:
    if cond is None:
        return f"{dbl('sum(c)')} / {dbl('100 * count(*)')}"
    return f"{dbl(f'sum(c) FILTER (WHERE {cond})')} / {dbl(f'100 * count(*) FILTER (WHERE {cond})')}"


def air_cte(forecast: bool = False) -> str:
    """Air readings; those of a forecast end at its time."""
    pol_to_type = {v: k for k, v in TYPE_TO_POLLUTANT.items()}
    cols = [f"{_mean_cents(f'event_type = {chr(39)}{pol_to_type[p]}{chr(39)}')} AS {p}" for p in AIR_COLUMNS
            if p != "us_aqi"]
    cols.append(f"{_mean_cents()} AS us_aqi")
    return f"""air AS (
  SELECT station, time, {', '.join(cols)}
  FROM ev{f' WHERE ts < {AS_OF_SQL}' if forecast else ''} GROUP BY station, time)"""


def weather_cte() -> str:
    return f"""weather AS (
  SELECT station, time,
    {_mean_cents()} AS temperature_2m,
    {dbl('sum(k)')} / {dbl('count(*)')} AS relative_humidity_2m,
    {dbl('max(c) - min(c)')} / {dbl('100')} AS precipitation,
    {dbl('1000')} + {dbl('min(k)')} AS surface_pressure,
    {dbl('count(*)')} AS wind_speed_10m,
    {dbl('sum(k) % 360')} AS wind_direction_10m,
    {dbl('max(k)')} AS cloud_cover
  FROM ev GROUP BY station, time)"""


def future_cte() -> str:
    return """future AS (
  SELECT w.* FROM weather w
  WHERE NOT EXISTS (SELECT 1 FROM air a WHERE a.station = w.station AND a.time = w.time))"""


def clean_cte(name: str, src: str, cols: list[str]) -> str:
    """drop-all-null then forward fill (per station, time order)."""
    fills = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in cols)
    allnull = " AND ".join(f"{c} IS NULL" for c in cols)
    return f"""{name} AS (
  SELECT station, time, {fills}
  FROM {src} WHERE NOT ({allnull}))"""


def merged_cte() -> str:
    return """merged AS (
  SELECT * FROM air_c JOIN weather_c USING (station, time))"""


CALENDAR_SQL = {
    "hour": "CAST(hour(time) AS INTEGER)",
    "day": "CAST(day(time) AS INTEGER)",
    "month": "CAST(month(time) AS INTEGER)",
    "day_of_week": "CAST(isodow(time) - 1 AS INTEGER)",
    "is_weekend": "CAST(CASE WHEN isodow(time) >= 6 THEN 1 ELSE 0 END AS INTEGER)",
}


def calendar_select(time: str = "time") -> str:
    return ", ".join(f"{e.replace('time', time)} AS {k}" for k, e in CALENDAR_SQL.items())


def lag_select(cols=POLLUTANTS, lags=LAG_HOURS) -> list[str]:
    return [f"lag({c}, {k}) OVER ({W}) AS {c}_lag_{k}h" for c in cols for k in lags]


def rolling_select(cols=POLLUTANTS, widths=ROLL_HOURS) -> list[str]:
    out = []
    for c in cols:
        for n in widths:
            fr = f"OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            out.append(f"avg({c}) {fr} AS {c}_roll_mean_{n}h")
            out.append(f"coalesce(stddev_samp({c}) {fr}, 0) AS {c}_roll_std_{n}h")
    return out


def engineered_cte(src: str = "merged", name: str = "feat") -> str:
    parts = [calendar_select(), *lag_select(), *rolling_select()]
    return f"""{name} AS (
  SELECT *, {', '.join(parts)} FROM {src})"""


def base_ctes(*extra: str, forecast: bool = False) -> str:
    """``WITH ev, air, weather[, extra...]``."""
    return "WITH " + ",\n".join([ev_cte(), air_cte(forecast), weather_cte(), *extra])


def features_ctes(*extra: str, forecast: bool = False) -> str:
    """... merged, feat (all rows), feat_full (rows without any missing value)."""
    d, i = feature_columns()
    cond = " AND ".join(f"{c} IS NOT NULL" for c in d + i)
    return merged_ctes(engineered_cte(), f"feat_full AS (SELECT * FROM feat WHERE {cond})", *extra, forecast=forecast)


def merged_ctes(*extra: str, forecast: bool = False) -> str:
    return base_ctes(
        clean_cte("air_c", "air", AIR_COLUMNS),
        clean_cte("weather_c", "weather", WEATHER_RAW_COLUMNS),
        merged_cte(),
        *extra,
        forecast=forecast,
    )


def feature_columns() -> tuple[list[str], list[str]]:
    """(double columns, int columns) of the feature table besides station and time."""
    doubles = list(AIR_COLUMNS) + list(WEATHER_RAW_COLUMNS)
    doubles += [f"{c}_lag_{k}h" for c in POLLUTANTS for k in LAG_HOURS]
    doubles += [f"{c}_roll_{s}_{n}h" for c in POLLUTANTS for n in ROLL_HOURS for s in ("mean", "std")]
    ints = list(CALENDAR_SQL)
    return doubles, ints


def rounded_select(doubles: list[str], others: list[str]) -> str:
    return ", ".join([*others, *[r6(c, c) for c in doubles]])


__all__ = [
    "AS_OF_SQL", "W", "WEATHER_COLS", "base_ctes", "merged_ctes", "engineered_cte", "feature_columns",
    "rounded_select", "r6", "dbl", "future_cte",
]
