"""Registered queries: forecast presentation, attribution and model scoring.

The prediction table here is the deterministic persistence forecast of the future
hours (``pred = lag_1h``, frozen at the last history value as in the reference) so the
SQL twins can recompute it; ``forecast`` scores the same rows with a fitted MLlib model.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS
from aerolith.functions import aqi as A
from aerolith.ml import explain, models
from aerolith.operators import features
from aerolith.operators import forecast as FC
from aerolith.operators import views as V
from aerolith.operators.evaluation import chrono_split
from aerolith.operators.select import materialised
from aerolith.plans import base
from aerolith.plans import q_forecast as QF
from aerolith.plans import sqlaqi as SA
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx
from aerolith.sources import store
from aerolith.sources.fixtures import WEATHER_RAW_COLUMNS

#: The view opens one day into the forecast.
VIEW_DAYS = 1
_VIEW_SQL = f"({S.AS_OF_SQL} + INTERVAL {VIEW_DAYS} DAY)"
_PREDS_COLS = [f"pred_{p}" for p in POLLUTANTS]
_PREDS = ("preds AS (SELECT f.station, f.time, " + ", ".join(f"f.{c}" for c in WEATHER_RAW_COLUMNS) + ", "
          + ", ".join(f"a.{p}_lag_1h AS pred_{p}" for p in POLLUTANTS)
          + f", {SA.pm25_forecast('a.pm2_5_lag_1h')} AS us_epa_aqi FROM future f JOIN asof_l a USING (station, time))")
_CTES = QF._CTES + ",\n" + _PREDS
_OUT = WEATHER_RAW_COLUMNS + _PREDS_COLS


def view_time(spark, sf_dir):
    return fx.as_of(spark, sf_dir) + timedelta(days=VIEW_DAYS)


def predictions(spark, sf_dir):
    f = FC.forecast_features(*QF.inputs(spark, sf_dir), include_rolling=False, include_calendar=False)
    p = f.select("station", "time", *WEATHER_RAW_COLUMNS,
                 *[F.col(f"{p}_lag_1h").alias(f"pred_{p}") for p in POLLUTANTS])
    return p.withColumn("us_epa_aqi", A.pm25_forecast_index("pred_pm2_5"))


@query("forecast_view", sql=f"""{_CTES}
SELECT station, time, {S.rounded_select(_OUT, [])}, us_epa_aqi FROM preds WHERE time >= {_VIEW_SQL}""")
def forecast_view(spark, sf_dir):
    """Forecast rows at or after the view time (a parameter, not now())."""
    return round_doubles(V.forecast_view(predictions(spark, sf_dir), view_time(spark, sf_dir)))


@query("current_status", sql=f"""{_CTES},
firsts AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY time) AS rn
           FROM preds WHERE time >= {_VIEW_SQL})
SELECT station, time, {S.rounded_select(_OUT, [])}, us_epa_aqi, {SA.status('us_epa_aqi')} AS status,
  us_epa_aqi > 100 AS alert FROM firsts WHERE rn = 1""")
def current_status(spark, sf_dir):
    """First forecast hour per station with status label and alert flag."""
    return round_doubles(V.current_status(predictions(spark, sf_dir), view_time(spark, sf_dir)))


@query("alerts", sql=f"""{_CTES}
SELECT station, time, us_epa_aqi FROM preds WHERE time >= {_VIEW_SQL} AND us_epa_aqi > 100""")
def alerts(spark, sf_dir):
    """Forecast hours with an index above 100."""
    return V.alerts(predictions(spark, sf_dir), view_time(spark, sf_dir)).select("station", "time", "us_epa_aqi")


def _stack_sql() -> str:
    parts, run = [], []
    for i, p in enumerate(POLLUTANTS):
        run.append(f"pred_{p}")
        parts.append(f"SELECT station, time, {i} AS level, '{p}' AS target, {S.q6(f'pred_{p}')} AS value, "
                     f"{S.q6(' + '.join(run))} AS stacked FROM preds")
    return _CTES + "\n" + "\nUNION ALL ".join(parts)


@query("pollutant_stack", sql=_stack_sql())
def pollutant_stack(spark, sf_dir):
    """Stacked pollutant forecast (value and running total in the fixed pollutant order)."""
    return round_doubles(V.pollutant_stack(predictions(spark, sf_dir)))


@query("source_fallback", sql=f"""{_CTES}
SELECT station, time, {S.rounded_select(_OUT, [])}, us_epa_aqi FROM preds""")
def source_fallback(spark, sf_dir):
    """The live source (forecasts after a future date: empty here) falls back to the local predictions."""
    p = predictions(spark, sf_dir)
    beyond = fx.as_of(spark, sf_dir) + timedelta(days=fx.FORECAST_DAYS + 1)  # after the last event
    live = p.where(F.col("time") >= F.lit(beyond).cast("timestamp_ntz"))
    return round_doubles(store.with_fallback(live, p))


_FEAT_DOUBLES, _FEAT_INTS = S.feature_columns()


@query("sample_rows", sql=f"""{S.features_ctes()}
SELECT {S.rounded_select(_FEAT_DOUBLES, ['station', 'time', *_FEAT_INTS])} FROM feat_full
ORDER BY md5('42|' || CAST(station AS VARCHAR) || '|' || CAST(time AS VARCHAR)), station, time LIMIT 1000""")
def sample_rows(spark, sf_dir):
    """A seeded, exact-size sample of 1000 feature rows."""
    return round_doubles(V.sample_rows(base.feature_table(spark, sf_dir), 1000, seed=42))


# ---------------------------------------------------------------- attribution

# Fixed weights of the linear lag-blend forecaster used for the exact attribution.
LAG_BLEND = {"lag_1h": 0.5, "lag_2h": 0.25, "lag_6h": 0.15, "lag_24h": 0.1}


def _coefs():
    return {p: {f"{p}_{k}": w for k, w in LAG_BLEND.items()} for p in POLLUTANTS}


def attribution(spark, sf_dir):
    test = chrono_split(base.feature_table(spark, sf_dir)).where(F.col("is_test"))
    return explain.linear_attribution(test, _coefs())


def _attr_sql() -> str:
    feats = sorted({f for c in _coefs().values() for f in c})
    means = "means AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}" for f in feats) + " FROM test)"
    parts = []
    for p, c in _coefs().items():
        base_e = " + ".join(f"CAST({w!r} AS DOUBLE) * m_{f}" for f, w in c.items())
        pred_e = " + ".join(f"CAST({w!r} AS DOUBLE) * {f}" for f, w in c.items())
        for f, w in c.items():
            parts.append(f"SELECT station, time, '{p}' AS target, '{f}' AS feature, {f} AS value, "
                         f"CAST({w!r} AS DOUBLE) * ({f} - m_{f}) AS contribution, "
                         f"CAST(0.0 AS DOUBLE) + {base_e} AS base, CAST(0.0 AS DOUBLE) + {pred_e} AS prediction "
                         f"FROM test, means")
    from aerolith.plans.q_eval import _SPLIT
    return S.features_ctes(_SPLIT, "test AS (SELECT * FROM split WHERE is_test)", means,
                           f"attr AS ({' UNION ALL '.join(parts)})")


@query("attribution_linear", sql=f"""{_attr_sql()}
SELECT station, time, target, feature, {S.rounded_select(['value', 'contribution', 'base', 'prediction'], [])}
FROM attr""")
def attribution_linear(spark, sf_dir):
    """M8: exact additive attribution of the lag-blend forecaster on the test rows (base + sum = prediction)."""
    return round_doubles(attribution(spark, sf_dir))


@query("attribution_summary", sql=f"""{_attr_sql()},
s AS (SELECT target, feature, avg(abs(contribution)) AS mean_abs FROM attr GROUP BY target, feature),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank
      FROM s)
SELECT target, feature, {S.q6('mean_abs')} AS mean_abs, rank FROM r WHERE rank <= 15""")
def attribution_summary(spark, sf_dir):
    """Mean |contribution| per feature, top 15 per pollutant."""
    return round_doubles(explain.attribution_summary(attribution(spark, sf_dir)))


@query("attribution_row", sql=f"""{_attr_sql()},
pick AS (SELECT * FROM attr WHERE target = 'pm2_5'
         AND (station, time) = (SELECT (station, time) FROM test ORDER BY station, time LIMIT 1)),
o AS (SELECT *, CAST(row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS step FROM pick)
SELECT station, time, target, feature, step,
  {S.rounded_select(['value', 'contribution', 'base', 'prediction'], [])},
  {S.q6('base + sum(contribution) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
    AS cumulative FROM o""")
def attribution_row(spark, sf_dir):
    """Waterfall of one explained row (the least station's first test hour, PM2.5)."""
    attr = attribution(spark, sf_dir)
    first = (chrono_split(base.feature_table(spark, sf_dir)).where(F.col("is_test"))
             .agg(F.min(F.struct("station", "time")).alias("__first"))).select("__first.*").toDF("__s0", "__t0")
    picked = attr.join(F.broadcast(first), (F.col("station") == F.col("__s0")) & (F.col("time") == F.col("__t0"))).drop("__s0", "__t0")
    return round_doubles(explain.waterfall(picked, F.lit(True), "pm2_5"))


@query("forecast")
def forecast(spark, sf_dir):
    """Linear models fitted on the train part, scored on the 72 future hours (rows-only check)."""
    air, weather = fx.landed(spark, sf_dir)
    table = materialised(chrono_split(features.build_features(air, weather, strategy="auto")), "features")
    m = models.fit(table.where(~F.col("is_test")), "linear")
    fut = FC.forecast_features(*QF.inputs_of(table, air, weather, fx.as_of(spark, sf_dir)))
    out = models.score_forecast(m, fut)
    return round_doubles(out.select("station", "time", *WEATHER_RAW_COLUMNS, *_PREDS_COLS, "us_epa_aqi"))
