"""Registered queries: index functions (§2.8) and descriptive statistics (§2.4)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from aerolith.config import CALENDAR_COLS, POLLUTANTS, WEATHER_COLS
from aerolith.functions import aqi as A
from aerolith.operators import stats
from aerolith.plans import base
from aerolith.plans import sqlaqi as SA
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources.fixtures import AIR_COLUMNS, WEATHER_RAW_COLUMNS

_AIR_C = S.clean_cte("air_c", "air", AIR_COLUMNS)

# ---------------------------------------------------------------- index functions


@query("aqi_subindex", sql=f"""{S.base_ctes()}
SELECT station, time, {', '.join(f'{SA.pollutant_subindex(p)} AS aqi_{p}' for p in POLLUTANTS)} FROM air""")
def aqi_subindex(spark, sf_dir):
    """The five sub-indices (reference mode) of every raw air hour; NULL stays NULL."""
    a = base.air(spark, sf_dir)
    return a.select("station", "time", *[A.pollutant_subindex(p).alias(f"aqi_{p}") for p in POLLUTANTS])


@query("aqi_overall", sql=f"""{S.base_ctes(_AIR_C)}
SELECT station, time, {SA.overall()} AS us_epa_aqi FROM air_c""")
def aqi_overall(spark, sf_dir):
    """overall index (max of the five sub-indices) of the cleaned air hours."""
    return base.air_clean(spark, sf_dir).select("station", "time", A.overall_aqi().alias("us_epa_aqi"))


@query("aqi_pm25", sql=f"""{S.base_ctes(_AIR_C)}
SELECT station, time, {S.r6('pm2_5', 'pm2_5')}, {SA.pm25_forecast()} AS us_epa_aqi FROM air_c""")
def aqi_pm25(spark, sf_dir):
    """PM2.5-only forecast index (500 outside the bands) of the cleaned air hours."""
    a = base.air_clean(spark, sf_dir)
    return round_doubles(a.select("station", "time", "pm2_5", A.pm25_forecast_index().alias("us_epa_aqi")))


@query("aqi_status", sql=f"""{S.base_ctes(_AIR_C)},
idx AS (SELECT station, time, {SA.overall()} AS aqi FROM air_c)
SELECT station, time, aqi, {SA.status('aqi')} AS status, CAST(aqi > 100 AS BOOLEAN) AS alert FROM idx""")
def aqi_status(spark, sf_dir):
    """Status label and alert flag of the overall index."""
    a = base.air_clean(spark, sf_dir).select("station", "time", A.overall_aqi().alias("aqi"))
    return a.select("station", "time", "aqi", A.status("aqi").alias("status"), A.is_alert("aqi").alias("alert"))


# ---------------------------------------------------------------- statistics

_STAT_COLS = AIR_COLUMNS + WEATHER_RAW_COLUMNS


def _describe_sql() -> str:
    parts = []
    for c in _STAT_COLS:
        parts.append(
            f"SELECT '{c}' AS variable, count({c}) AS count, {S.q6(f'avg({c})')} AS mean, "
            f"{S.q6(f'stddev_samp({c})')} AS std, {S.q6(f'min({c})')} AS min, "
            f"{S.q6(f'quantile_cont({c}, 0.25)')} AS p25, {S.q6(f'quantile_cont({c}, 0.5)')} AS p50, "
            f"{S.q6(f'quantile_cont({c}, 0.75)')} AS p75, {S.q6(f'max({c})')} AS max FROM merged")
    return S.merged_ctes() + "\n" + "\nUNION ALL ".join(parts)


@query("describe_stats", sql=_describe_sql())
def describe_stats(spark, sf_dir):
    """A1, A2: count, mean, std, min, quartiles (exact, linear), max of every reading of the merged table."""
    d = stats.describe(base.merged(spark, sf_dir), _STAT_COLS).withColumnRenamed("column", "variable")
    return round_doubles(d)


def _corr_matrix_sql() -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, {S.q6(f'corr({a}, {b})')} AS r FROM merged"
             for a in _STAT_COLS for b in _STAT_COLS]
    return S.merged_ctes() + "\n" + "\nUNION ALL ".join(parts)


@query("corr_matrix", sql=_corr_matrix_sql())
def corr_matrix(spark, sf_dir):
    """A3: pairwise-complete Pearson correlation of all readings, long form (a, b, r)."""
    return round_doubles(stats.corr_matrix(base.merged(spark, sf_dir), _STAT_COLS))


_TARGET_FEATS = WEATHER_COLS + CALENDAR_COLS


def _corr_target_sql() -> str:
    parts = [f"SELECT '{f}' AS feature, corr({f}, pm2_5) AS r FROM feat_full" for f in _TARGET_FEATS]
    return (S.features_ctes(f"c AS ({' UNION ALL '.join(parts)})") + f"""
SELECT feature, {S.q6('r')} AS r,
  CAST(row_number() OVER (ORDER BY (r IS NULL OR isnan(r)), r DESC, feature) AS INTEGER) AS rank FROM c""")


@query("corr_target", sql=_corr_target_sql())
def corr_target(spark, sf_dir):
    """Correlation of each base feature with PM2.5, ranked (NaN last)."""
    return round_doubles(stats.corr_with_target(base.feature_table(spark, sf_dir), _TARGET_FEATS, "pm2_5"))


_AC_LAGS = [1, 2, 3, 6, 12, 24, 48, 72]


def _autocorr_sql() -> str:
    lags = ", ".join(f"lag(pm2_5, {k}) OVER ({S.W}) AS l{k}" for k in _AC_LAGS)
    parts = [f"SELECT station, {k} AS lag, {S.q6(f'corr(pm2_5, l{k})')} AS autocorr FROM lagged GROUP BY station"
             for k in _AC_LAGS]
    return S.features_ctes(f"lagged AS (SELECT station, pm2_5, {lags} FROM feat_full)") + "\n" + \
        "\nUNION ALL ".join(parts)


@query("autocorr", sql=_autocorr_sql())
def autocorr(spark, sf_dir):
    """A5: PM2.5 autocorrelation at lags 1-72 rows per station on the feature table."""
    return round_doubles(stats.autocorr(base.feature_table(spark, sf_dir), "pm2_5", _AC_LAGS))


_HIST_BINS = [50, 80]


def _histogram_sql() -> str:
    return S.features_ctes(
        "rng AS (SELECT min(pm2_5) AS mn, max(pm2_5) AS mx FROM feat_full)",
        "nb AS (SELECT * FROM (VALUES (50), (80)) v(n))",
        """binned AS (
  SELECT n, CAST(CASE WHEN mx - mn > 0 THEN least(floor((pm2_5 - mn) * CAST(n AS DOUBLE) / (mx - mn)), n - 1)
                 ELSE 0 END AS INTEGER) AS bin
  FROM feat_full, rng, nb WHERE pm2_5 IS NOT NULL)""",
        "cnt AS (SELECT n, bin, count(*) AS c FROM binned GROUP BY n, bin)",
        "grid AS (SELECT n, CAST(g.range AS INTEGER) AS bin, mn, mx FROM nb, rng, range(0, 80) g WHERE g.range < n)",
    ) + f"""
SELECT CAST(grid.n AS INTEGER) AS bins, grid.bin,
  {S.q6('mn + grid.bin * (mx - mn) / CAST(grid.n AS DOUBLE)')} AS lo,
  {S.q6('mn + (grid.bin + 1) * (mx - mn) / CAST(grid.n AS DOUBLE)')} AS hi,
  coalesce(cnt.c, 0) AS count
FROM grid LEFT JOIN cnt ON grid.n = cnt.n AND grid.bin = cnt.bin"""


@query("histogram", sql=_histogram_sql())
def histogram(spark, sf_dir):
    """Equal-width PM2.5 histograms with 50 and 80 bins (max value in the last bin)."""
    return round_doubles(stats.histogram(base.feature_table(spark, sf_dir), "pm2_5", _HIST_BINS))


def _kde_sql(gridsize: int = 200) -> str:
    return S.features_ctes(
        f"""st AS (SELECT CAST(count(pm2_5) AS DOUBLE) AS n, min(pm2_5) AS mn, max(pm2_5) AS mx,
  pow(CAST(count(pm2_5) AS DOUBLE), CAST(-0.2 AS DOUBLE)) * stddev_samp(pm2_5) AS h,
  (max(pm2_5) - min(pm2_5)) / CAST({gridsize - 1} AS DOUBLE) AS step FROM feat_full)""",
        "d AS (SELECT pm2_5 AS x, count(*) AS w FROM feat_full WHERE pm2_5 IS NOT NULL GROUP BY pm2_5)",
        f"pts AS (SELECT CAST(range AS INTEGER) AS point FROM range(0, {gridsize}))",
    ) + f"""
SELECT point, {S.q6('min(mn + point * step)')} AS x,
  {S.q6(f'sum(w * exp(-(((mn + point * step) - x) / h) * (((mn + point * step) - x) / h) / CAST(2 AS DOUBLE)))'
        f' / min(n * h * CAST({math.sqrt(2 * math.pi)!r} AS DOUBLE))')} AS density
FROM pts, st, d GROUP BY point"""


@query("kde_grid", sql=_kde_sql())
def kde_grid(spark, sf_dir):
    """Gaussian KDE of PM2.5 on 200 points (Scott bandwidth)."""
    return round_doubles(stats.kde_grid(base.feature_table(spark, sf_dir), "pm2_5", 200))


def _box_sql() -> str:
    return S.features_ctes(
        """q AS (SELECT station, quantile_cont(pm2_5, 0.25) AS q1, quantile_cont(pm2_5, 0.5) AS median,
  quantile_cont(pm2_5, 0.75) AS q3 FROM feat_full GROUP BY station)""",
        """j AS (SELECT f.station, pm2_5 AS x, q1, median, q3,
  (pm2_5 >= q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AND pm2_5 <= q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)) AS inside
  FROM feat_full f JOIN q USING (station) WHERE pm2_5 IS NOT NULL)""",
    ) + f"""
SELECT station, {S.q6('q1')} AS q1, {S.q6('median')} AS median, {S.q6('q3')} AS q3,
  {S.q6('min(x) FILTER (WHERE inside)')} AS whisker_lo, {S.q6('max(x) FILTER (WHERE inside)')} AS whisker_hi,
  count(*) FILTER (WHERE NOT inside) AS n_outliers
FROM j GROUP BY station, q1, median, q3"""


@query("box_stats", sql=_box_sql())
def box_stats(spark, sf_dir):
    """PM2.5 box-plot numbers per station (quartiles, 1.5 IQR whiskers, outlier count)."""
    return round_doubles(stats.box_stats(base.feature_table(spark, sf_dir), "pm2_5", ["station"]))


@query("quality_report", sql=S.features_ctes() + """
SELECT station, count(*) FILTER (WHERE step = 'a') AS n_air, count(*) FILTER (WHERE step = 'w') AS n_weather,
  count(*) FILTER (WHERE step = 'm') AS n_merged, count(*) FILTER (WHERE step = 'f') AS n_features,
  count(*) FILTER (WHERE step = 'm') - count(*) FILTER (WHERE step = 'f') AS n_dropped
FROM (SELECT station, 'a' AS step FROM air UNION ALL SELECT station, 'w' FROM weather
  UNION ALL SELECT station, 'm' FROM merged UNION ALL SELECT station, 'f' FROM feat_full)
GROUP BY station""")
def quality_report(spark, sf_dir):
    """Per-station row counts through the feature steps and rows dropped by dropna; no station is left out."""
    from aerolith.operators.features import engineer
    d, i = S.feature_columns()
    whole = F.lit(True)
    for c in d + i:
        whole &= F.col(c).isNotNull()
    step = lambda df, name, full=F.lit(False): df.select("station", F.lit(name).alias("step"), full.alias("full"))
    rows = (step(base.air(spark, sf_dir), "a").unionByName(step(base.weather(spark, sf_dir), "w"))
            .unionByName(step(engineer(base.merged(spark, sf_dir)), "m", whole)))
    out = rows.groupBy("station").agg(
        *[F.count_if(F.col("step") == k).alias(n) for k, n in (("a", "n_air"), ("w", "n_weather"), ("m", "n_merged"))],
        F.count_if(F.col("full")).alias("n_features"))
    return out.withColumn("n_dropped", F.col("n_merged") - F.col("n_features"))


@query("aqi_epa", sql=f"""{S.base_ctes()}
SELECT station, time, {SA.pm25_epa('pm2_5')} AS aqi_pm2_5 FROM air""")
def aqi_epa(spark, sf_dir):
    """F9, second mode: PM2.5 sub-index of the concentration truncated to tenths, of every raw air hour."""
    a = base.air(spark, sf_dir)
    return a.select("station", "time", A.subindex("pm2_5", A.BANDS["pm2_5"], mode="epa", precision=0.1).alias("aqi_pm2_5"))


@query("aqi_pm25_epa", sql=f"""{S.base_ctes()}
SELECT station, time, {SA.pm25_forecast_epa('pm2_5')} AS us_epa_aqi FROM air""")
def aqi_pm25_epa(spark, sf_dir):
    """F12, second mode: PM2.5 forecast index of the concentration truncated to tenths, NULL for missing and negative values."""
    a = base.air(spark, sf_dir)
    return a.select("station", "time", A.pm25_forecast_index("pm2_5", mode="epa").alias("us_epa_aqi"))
