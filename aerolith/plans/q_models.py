"""Registered queries: training job, forecast with the loaded best model, sampled attribution, global split.

The models here have one input, so that SQL can fit them, too (``regr_slope``, ``regr_intercept``); the job is the one that
trains all kinds on 51 features (``aerolith.ml.training``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS, scratch_path
from aerolith.functions import aqi as A
from aerolith.ml import shapley, training
from aerolith.operators import evaluation as E
from aerolith.operators.select import materialised
from aerolith.plans import base
from aerolith.plans import sqlaqi as SA
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.q_eval import _AQI_MAE, _METRICS, _SPLIT, _long_cte
from aerolith.plans.q_views import LAG_BLEND, _attr_sql, _coefs
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx
from aerolith.sources import store

ONE = "temperature_2m"
_GLOBAL = """gsplit AS (
  SELECT *, row_number() OVER (ORDER BY time, station) > (count(*) OVER () * 8) // 10 AS is_test FROM feat_full)"""
_COEF = "coef AS (SELECT " + ", ".join(f"regr_slope({p}, {ONE}) AS s_{p}, regr_intercept({p}, {ONE}) AS i_{p}" for p in POLLUTANTS) + \
    ", count(*) AS train_samples FROM gsplit WHERE NOT is_test)"
_FITTED = ", ".join(f"s_{p} * {ONE} + i_{p} AS pred_{p}" for p in POLLUTANTS)


@query("chrono_split_global", sql=f"""{S.features_ctes(_GLOBAL)}
SELECT station, time, is_test FROM gsplit""")
def chrono_split_global(spark, sf_dir):
    """M1, W7 without keys: the last 20 % of all feature rows in (time, station) order are the test part; the cut is found by selection."""
    rows = materialised(base.feature_table(spark, sf_dir).select("station", "time"), "features")
    return E.chrono_split(rows, (), tiebreak=["station"])


def trained(spark, sf_dir) -> str:
    """The folder of a training run with one input, and its rows in the run table."""
    table = base.feature_table(spark, sf_dir).select("station", "time", ONE, *POLLUTANTS)
    root = scratch_path(spark, "models")
    training.train(table, root, {"one_input": {"kind": "linear"}}, [ONE], tiebreak=["station"], note="one input")
    return root


@query("training_job", sql=f"""{S.features_ctes(_GLOBAL, _COEF, f"t AS (SELECT g.*, {_FITTED} FROM gsplit g, coef WHERE is_test)", _long_cte("t", "lg"))},
m AS (SELECT target, {_METRICS} FROM lg GROUP BY target)
SELECT 'one_input' AS model_name, 'linear' AS kind, (SELECT train_samples FROM coef) AS train_samples,
  {S.q6('round_even(avg(mae), 4)')} AS mae, {S.q6('round_even(avg(rmse), 4)')} AS rmse, {S.q6('round_even(avg(r2), 4)')} AS r2,
  {S.q6(f'(SELECT round_even({_AQI_MAE}, 4) FROM t)')} AS aqi_mae FROM m""")
def training_job(spark, sf_dir):
    """Split, fit, evaluate, append to the run table, save; the run's rows of that table."""
    runs = training.runs(spark, trained(spark, sf_dir))
    return round_doubles(runs.select("model_name", "kind", "train_samples", "mae", "rmse", "r2", "aqi_mae"))


@query("forecast_best_model", sql=f"""{S.features_ctes(_GLOBAL, _COEF, S.future_cte().replace("air a", "(SELECT * FROM ev_air) a"), forecast=False)
                                          .replace("future AS (", f"ev_air AS (SELECT station, time FROM ev WHERE ts < {S.AS_OF_SQL}),{chr(10)}future AS (")},
p AS (SELECT f.station, f.time, {_FITTED} FROM future f, coef)
SELECT station, time, {S.rounded_select([f'pred_{p}' for p in POLLUTANTS], [])}, {SA.pm25_forecast('pred_pm2_5')} AS us_epa_aqi FROM p""")
def forecast_best_model(spark, sf_dir):
    """The best model of the run table, loaded from its folder, scores the future hours."""
    model = training.load_best(spark, trained(spark, sf_dir), "mae", "min")
    future = model.transform(fx.future_weather(spark, sf_dir).select("station", "time", ONE))
    out = future.withColumn("us_epa_aqi", A.pm25_forecast_index("pred_pm2_5"))
    return round_doubles(out.select("station", "time", *[f"pred_{p}" for p in POLLUTANTS], "us_epa_aqi"))


def _sampled_sql() -> str:
    features = [f"{p}_{k}" for p in POLLUTANTS for k in LAG_BLEND]
    zeros = [f"SELECT t.station, t.time, a.target, '{f}' AS feature, t.{f} AS value, CAST(0 AS DOUBLE) AS contribution, a.base, a.prediction "
             f"FROM test t JOIN per a ON a.station = t.station AND a.time = t.time WHERE NOT starts_with('{f}', a.target || '_lag')" for f in features]
    return f"""{_attr_sql()},
per AS (SELECT DISTINCT station, time, target, base, prediction FROM attr),
every AS (SELECT * FROM attr UNION ALL {' UNION ALL '.join(zeros)})
SELECT station, time, target, feature, {S.rounded_select(['value', 'contribution', 'base', 'prediction'], [])} FROM every"""


@query("attribution_sampled", sql=_sampled_sql())
def attribution_sampled(spark, sf_dir):
    """M8 by sampled permutations, of every test row: the lag blend scored as a black box over all 20 lags has its exact attribution."""
    features = [f"{p}_{k}" for p in POLLUTANTS for k in LAG_BLEND]
    table = E.chrono_split(base.feature_table(spark, sf_dir)).where(F.col("is_test"))
    test = materialised(table.select("station", "time", *features), "explained")

    def blend(rows):
        return rows.withColumns({f"pred_{p}": sum((F.lit(float(w)) * F.col(f) for f, w in c.items()), F.lit(0.0)) for p, c in _coefs().items()})

    return round_doubles(shapley.sampled_shapley(test, blend, features, POLLUTANTS, permutations=2))
