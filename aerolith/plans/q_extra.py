"""Registered queries of the operators the reference documents without code (§2.12 N1, N2, N4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import aqi as A
from aerolith.operators import stats
from aerolith.plans import base
from aerolith.plans import sqlaqi as SA
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources.fixtures import AIR_COLUMNS

_AIR_C = S.clean_cte("air_c", "air", AIR_COLUMNS)


@query("aqi_change_rate", sql=f"""{S.base_ctes(_AIR_C)},
idx AS (SELECT station, time, {SA.overall()} AS aqi FROM air_c),
lagged AS (SELECT *, lag(aqi) OVER ({S.W}) AS prev FROM idx)
SELECT station, time, aqi, prev AS prev_aqi,
  {S.q6('CASE WHEN prev = 0 THEN NULL ELSE CAST(aqi - prev AS DOUBLE) / CAST(prev AS DOUBLE) END')} AS change_rate
FROM lagged""")
def aqi_change_rate(spark, sf_dir):
    """Hour-over-hour change rate of the overall index per station, (x - lag x) / lag x."""
    idx = base.air_clean(spark, sf_dir).select("station", "time", A.overall_aqi().alias("aqi"))
    prev = F.expr("lag(aqi) OVER (PARTITION BY station ORDER BY time)")
    out = idx.withColumn("prev_aqi", prev).withColumn(
        "change_rate", F.try_divide((F.col("aqi") - F.col("prev_aqi")).cast("double"),
                                    F.col("prev_aqi").cast("double")))
    return round_doubles(out)


@query("feature_interactions", sql=f"""{S.features_ctes()}
SELECT station, time, {S.r6('wind_speed_10m * pm2_5_lag_1h', 'wind_x_pm2_5_lag_1h')},
  {S.r6('temperature_2m * relative_humidity_2m', 'temp_x_humidity')} FROM feat_full""")
def feature_interactions(spark, sf_dir):
    """Interaction features wind x PM2.5 lag 1 h and temperature x humidity."""
    f = base.feature_table(spark, sf_dir)
    return round_doubles(f.select("station", "time",
                                  (F.col("wind_speed_10m") * F.col("pm2_5_lag_1h")).alias("wind_x_pm2_5_lag_1h"),
                                  (F.col("temperature_2m") * F.col("relative_humidity_2m")).alias("temp_x_humidity")))


@query("outlier_filter", sql=f"""{S.features_ctes()},
q AS (SELECT station, quantile_cont(pm2_5, 0.25) AS q1, quantile_cont(pm2_5, 0.75) AS q3 FROM feat_full GROUP BY station)
SELECT f.station, f.time, {S.r6('f.pm2_5', 'pm2_5')} FROM feat_full f JOIN q USING (station)
WHERE f.pm2_5 >= q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AND f.pm2_5 <= q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)""")
def outlier_filter(spark, sf_dir):
    """Feature rows whose PM2.5 lies within the per-station 1.5 IQR fences."""
    f = base.feature_table(spark, sf_dir)
    return round_doubles(stats.outlier_filter(f, "pm2_5", ["station"]).select("station", "time", "pm2_5"))
