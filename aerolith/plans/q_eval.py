"""Registered queries: chronological split, evaluation, residuals, run history (§2.4 A8-A13, A18-A20, M1, M6, M10).

Predictions here come from deterministic baseline forecasters on the test part of the
feature table (persistence ``pred = lag_1h``, daily persistence ``lag_24h``, 6-hour
mean ``roll_mean_6h``), so SQL can recompute every number.  The MLlib models run
through the same operators (``aerolith.ml``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS
from aerolith.functions.calendar import calendar_columns
from aerolith.operators import evaluation as E
from aerolith.operators.select import materialised
from aerolith.plans import base
from aerolith.plans import sqlaqi as SA
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx

# Fixed baseline forecasters: name -> source column suffix of the prediction.
BASELINES = {"persistence_1h": "lag_1h", "persistence_24h": "lag_24h", "mean_6h": "roll_mean_6h"}
NOTE = "baselines on stand-in data"


def split(spark, sf_dir):
    return E.chrono_split(base.feature_table(spark, sf_dir))


def test_with_predictions(spark, sf_dir, suffix="lag_1h"):
    t = split(spark, sf_dir).where(F.col("is_test"))
    return t.withColumns({f"pred_{p}": F.col(f"{p}_{suffix}") for p in POLLUTANTS})


_SPLIT = """split AS (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY time)
            > (count(*) OVER (PARTITION BY station) * 8) // 10 AS is_test FROM feat_full)"""


def _test_cte(name="test", suffix="lag_1h"):
    preds = ", ".join(f"{p}_{suffix} AS pred_{p}" for p in POLLUTANTS)
    return f"{name} AS (SELECT *, {preds} FROM split WHERE is_test)"


def _long_cte(src="test", name="long"):
    parts = [f"SELECT station, time, '{p}' AS target, {p} AS actual, pred_{p} AS predicted FROM {src}"
             for p in POLLUTANTS]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


_METRICS = """count(*) AS n, avg(abs(actual - predicted)) AS mae,
  sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
  CASE WHEN var_pop(actual) * count(*) = 0
       THEN CASE WHEN sum((actual - predicted) * (actual - predicted)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) END AS r2"""


@query("chrono_split", sql=f"""{S.features_ctes(_SPLIT)}
SELECT station, time, is_test FROM split""")
def chrono_split(spark, sf_dir):
    """The last 20 % of each station's feature rows (time order) are the test part."""
    return split(spark, sf_dir).select("station", "time", "is_test")


@query("eval_metrics", sql=f"""{S.features_ctes(_SPLIT, _test_cte(), _long_cte())},
m AS (SELECT target, {_METRICS} FROM long GROUP BY target)
SELECT target, n, {S.rounded_select(['mae', 'rmse', 'r2'], [])} FROM m""")
def eval_metrics(spark, sf_dir):
    """MAE, RMSE, R2 per pollutant of the persistence forecast on the test part."""
    return round_doubles(E.metrics(test_with_predictions(spark, sf_dir)))


_AQI_MAE = (f"avg(CAST(abs(({SA.overall()}) - ({SA.overall([f'pred_{p}' for p in POLLUTANTS])})) AS DOUBLE))")


@query("eval_aqi_mae", sql=f"""{S.features_ctes(_SPLIT, _test_cte())}
SELECT count(*) AS n, {S.q6(_AQI_MAE)} AS aqi_mae FROM test""")
def eval_aqi_mae(spark, sf_dir):
    """MAE of the overall index (truth vs prediction) of the persistence forecast."""
    return round_doubles(E.aqi_mae(test_with_predictions(spark, sf_dir)))


def _summary_sql(name: str, suffix: str, idx: int) -> tuple[list[str], str]:
    t, lg = f"t{idx}", f"lg{idx}"
    ctes = [_test_cte(t, suffix), _long_cte(t, lg)]
    sel = f"""SELECT '{name}' AS model_name,
  round_even(avg(mae), 4) AS mae, round_even(avg(rmse), 4) AS rmse, round_even(avg(r2), 4) AS r2,
  (SELECT round_even({_AQI_MAE}, 4) FROM {t}) AS aqi_mae
FROM (SELECT target, {_METRICS} FROM {lg} GROUP BY target)"""
    return ctes, sel


def _runs_sql(select_tail: str) -> str:
    ctes, sels = [_SPLIT], []
    for i, (name, suffix) in enumerate(BASELINES.items()):
        c, s = _summary_sql(name, suffix, i)
        ctes += c
        sels.append(s)
    runs = f"""runs AS (
  SELECT {S.AS_OF_SQL} AS timestamp, model_name, 'MULTI_OUTPUT' AS target,
         mae, rmse, r2, aqi_mae, '{NOTE}' AS experiment_note
  FROM ({' UNION ALL '.join(sels)}))"""
    return S.features_ctes(*ctes, runs) + "\n" + select_tail


def runs(spark, sf_dir):
    """One summary row per baseline forecaster, as appended to the run history."""
    t = split(spark, sf_dir).where(F.col("is_test"))
    preds = [F.col(f"{p}_{suffix}").alias(f"pred_{m}_{p}") for m, suffix in BASELINES.items() for p in POLLUTANTS]
    t = materialised(t.select(*POLLUTANTS, *preds), "scored")  # the summaries read it twice
    out = E.summaries(t, {m: f"pred_{m}_" for m in BASELINES})
    return out.select(F.lit(fx.as_of(spark, sf_dir)).cast("timestamp_ntz").alias("timestamp"), "model_name",
                      F.lit("MULTI_OUTPUT").alias("target"), "mae", "rmse", "r2", "aqi_mae",
                      F.lit(NOTE).alias("experiment_note"))


@query("eval_summary", sql=_runs_sql(f"SELECT model_name, {S.rounded_select(['mae', 'rmse', 'r2', 'aqi_mae'], [])} "
                                     "FROM runs"))
def eval_summary(spark, sf_dir):
    """Per model the target-averaged MAE/RMSE/R2 and index MAE, rounded half-even to 4."""
    return round_doubles(runs(spark, sf_dir).select("model_name", "mae", "rmse", "r2", "aqi_mae"))


@query("model_history", sql=_runs_sql(
    f"SELECT timestamp, model_name, target, experiment_note, {S.rounded_select(['mae', 'rmse', 'r2', 'aqi_mae'], [])}"
    " FROM runs"))
def model_history(spark, sf_dir):
    """The run-history rows appended after an evaluation (timestamp = the run's as-of time)."""
    return round_doubles(runs(spark, sf_dir))


@query("best_model", sql=_runs_sql(
    f"SELECT model_name, {S.rounded_select(['mae', 'r2'], [])} FROM runs ORDER BY mae, model_name LIMIT 1"))
def best_model(spark, sf_dir):
    """The model with the lowest average MAE (ties: name)."""
    from aerolith.sources.store import best_by

    return round_doubles(best_by(runs(spark, sf_dir), "mae", "min").select("model_name", "mae", "r2"))


@query("history_leaderboard", sql=_runs_sql(f"""SELECT experiment_note, model_name, {S.rounded_select(['mae', 'aqi_mae'], [])},
  mae = min(mae) OVER () AS best_mae, aqi_mae = min(aqi_mae) OVER () AS best_aqi_mae FROM runs"""))
def history_leaderboard(spark, sf_dir):
    """Runs ranked by MAE with the column minima of mae and aqi_mae flagged."""
    from aerolith.operators.views import leaderboard

    return round_doubles(leaderboard(runs(spark, sf_dir)))


@query("residuals", sql=f"""{S.features_ctes(_SPLIT, _test_cte(), _long_cte())}
SELECT station, time, target, {S.rounded_select(['actual', 'predicted'], [])},
  {S.r6('actual - predicted', 'residual')} FROM long""")
def residuals(spark, sf_dir):
    """Actual, predicted and residual per test row and pollutant."""
    return round_doubles(E.residuals(test_with_predictions(spark, sf_dir)))


@query("residual_extremes", sql=f"""{S.features_ctes(_SPLIT, _test_cte(), _long_cte())}
SELECT target, count(*) FILTER (WHERE actual - predicted > 20) AS n_under,
  count(*) FILTER (WHERE actual - predicted < -20) AS n_over FROM long GROUP BY target""")
def residual_extremes(spark, sf_dir):
    """Residuals beyond +-20 per pollutant."""
    return E.residual_extremes(test_with_predictions(spark, sf_dir))


@query("residuals_by_hour", sql=f"""{S.features_ctes(_SPLIT, _test_cte(), _long_cte())}
SELECT target, CAST(hour(time) AS INTEGER) AS by, count(*) AS n,
  {S.q6('avg(actual - predicted)')} AS mean_residual, {S.q6('stddev_samp(actual - predicted)')} AS std_residual
FROM long GROUP BY target, CAST(hour(time) AS INTEGER)""")
def residuals_by_hour(spark, sf_dir):
    """Residual mean/std by hour of day per pollutant."""
    t = test_with_predictions(spark, sf_dir)
    return round_doubles(E.residuals_by(t, calendar_columns()["hour"]))


def _by_band(col: str, width: int) -> str:
    return f"""{S.features_ctes(_SPLIT, _test_cte(), _long_cte())},
banded AS (SELECT l.*, CAST(floor(t.{col} / CAST({width} AS DOUBLE)) * {width} AS BIGINT) AS "by" FROM long l JOIN test t USING (station, time))
SELECT target, "by", count(*) AS n, {S.q6('avg(actual - predicted)')} AS mean_residual, {S.q6('stddev_samp(actual - predicted)')} AS std_residual
FROM banded GROUP BY ALL"""


def _residuals_by_band(spark, sf_dir, col, width):
    t = test_with_predictions(spark, sf_dir)
    return round_doubles(E.residuals_by(t, (F.floor(F.col(col) / F.lit(float(width))) * width).cast("bigint")))


@query("residuals_by_temperature", sql=_by_band("temperature_2m", 20))
def residuals_by_temperature(spark, sf_dir):
    """Residual mean/std by temperature band per pollutant."""
    return _residuals_by_band(spark, sf_dir, "temperature_2m", 20)


@query("residuals_by_humidity", sql=_by_band("relative_humidity_2m", 10))
def residuals_by_humidity(spark, sf_dir):
    """Residual mean/std by humidity band per pollutant."""
    return _residuals_by_band(spark, sf_dir, "relative_humidity_2m", 10)


@query("history_appended", sql=_runs_sql(f"""SELECT model_name, experiment_note, {S.r6('mae', 'mae')} FROM runs
UNION ALL SELECT model_name, 'second run' AS experiment_note, {S.r6('mae', 'mae')} FROM runs"""))
def history_appended(spark, sf_dir):
    """Two runs appended to the history table, read back as one."""
    from aerolith.config import scratch_path
    from aerolith.sources.store import append_history

    path = scratch_path(spark, "history")
    run = runs(spark, sf_dir)
    append_history(spark, run, path)
    append_history(spark, spark.read.parquet(path).withColumn("experiment_note", F.lit("second run")), path)
    return round_doubles(spark.read.parquet(path).select("model_name", "experiment_note", "mae"))
