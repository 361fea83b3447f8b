"""Registered queries: sources, sinks and the feature store (§2.1, P1, P3, P5-P7, P13, U1)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from aerolith.config import scratch_path
from aerolith.plans import base
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import files, store
from aerolith.sources import fixtures as fx
from aerolith.sources.fixtures import AIR_COLUMNS, WEATHER_RAW_COLUMNS

# Unit-bearing header names as the source writes them.
UNIT_HEADER = {
    "station": "Station",
    "time": "time",
    "pm10": "PM10 (μg/m³)",
    "pm2_5": "PM2_5 (μg/m³)",
    "carbon_monoxide": "Carbon Monoxide (μg/m³)",
    "nitrogen_dioxide": "Nitrogen Dioxide (μg/m³)",
    "sulphur_dioxide": "Sulphur Dioxide (μg/m³)",
    "us_aqi": "US AQI ()",
    "temperature_2m": "Temperature 2m (°C)",
    "relative_humidity_2m": "Relative Humidity-2m (%)",
    "precipitation": "Precipitation (mm)",
    "surface_pressure": "Surface Pressure (hPa)",
    "wind_speed_10m": "Wind Speed-10m (km/h)",
    "wind_direction_10m": "Wind Direction-10m (°)",
    "cloud_cover": "Cloud Cover (%)",
}
PREAMBLE = ["latitude,longitude,elevation,utc_offset_seconds,timezone", "0.0,0.0,0.0,0,GMT", ""]


@query("src_csv_preamble", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(AIR_COLUMNS, [])} FROM air""")
def src_csv_preamble(spark, sf_dir):
    """Air hours landed as CSV with a 3-line preamble and unit headers, read back and renamed."""
    a = fx.air(spark, sf_dir)
    path = scratch_path(spark, "air-csv")
    cols = ["time", "station", *AIR_COLUMNS]
    files.write_csv_preamble(spark, a.select(*cols), path, [UNIT_HEADER[c] for c in cols], PREAMBLE)
    names = list(files.normalise_names(files.header_names(spark, path)).clean.values())
    schema = StructType([StructField(n, TimestampNTZType() if n == "time" else LongType() if n == "station"
                                     else DoubleType()) for n in names])
    return round_doubles(files.read_csv_preamble(spark, path, schema))


# A cell of each line is damaged by the row's hour: NaN, nothing, text, and a cell too many.
_DAMAGE = {0: "NaN", 1: "", 2: "n/a", 3: "1.5,9"}


@query("src_csv_rejects", sql=f"""{S.base_ctes()}
SELECT station, time, CASE WHEN hour(time) IN (0, 1) THEN NULL ELSE {S.q6('pm10')} END AS pm10, {S.r6('pm2_5', 'pm2_5')}, FALSE AS rejected
FROM air WHERE hour(time) NOT IN (2, 3)
UNION ALL SELECT station, time, NULL AS pm10, NULL AS pm2_5, TRUE AS rejected FROM air WHERE hour(time) IN (2, 3)""")
def src_csv_rejects(spark, sf_dir):
    """Air hours landed as plain CSV with damaged cells; NaN and empty cells are NULL, lines that do not fit go to the reject table."""
    a = fx.air(spark, sf_dir)
    root = scratch_path(spark, "air-csv")
    schema = StructType([StructField("station", LongType()), StructField("time", TimestampNTZType()), StructField("pm2_5", DoubleType()), StructField("pm10", DoubleType())])
    damaged = F.coalesce(F.col("pm10").cast("string"), F.lit(""))
    for hour, cell in _DAMAGE.items():
        damaged = F.when(F.hour("time") == hour, F.lit(cell)).otherwise(damaged)
    stamp = F.date_format("time", "yyyy-MM-dd'T'HH:mm")
    line = F.concat_ws(",", F.col("station").cast("string"), stamp, F.coalesce(F.col("pm2_5").cast("string"), F.lit("")), damaged)
    a.select(line.alias("station,time,pm2_5,pm10")).write.option("header", True).option("quote", "\u0000").option("sep", "\u0001").csv(f"{root}/in")
    files.load_csv(spark, f"{root}/in", schema, f"{root}/good", f"{root}/rejects", files.CSV_TIME_FORMAT)
    good = spark.read.parquet(f"{root}/good").withColumn("rejected", F.lit(False))
    bad = spark.read.parquet(f"{root}/rejects").select(
        F.split("line", ",")[0].cast("long").alias("station"), F.to_timestamp_ntz(F.split("line", ",")[1], F.lit(files.CSV_TIME_FORMAT)).alias("time"),
        F.lit(None).cast("double").alias("pm10"), F.lit(None).cast("double").alias("pm2_5"), F.lit(True).alias("rejected"))
    return round_doubles(good.unionByName(bad))


@query("rename_clean", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(WEATHER_RAW_COLUMNS, [])} FROM weather""")
def rename_clean(spark, sf_dir):
    """Unit-bearing column names cleaned to ^[a-z][a-z0-9_]*$ (schema-level)."""
    w = fx.weather(spark, sf_dir)
    raw = w.toDF(*[UNIT_HEADER[c] for c in w.columns])
    return round_doubles(files.rename_clean(raw))


@query("parse_time", sql="""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time_text,
  strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS time FROM events""")
def parse_time(spark, sf_dir):
    """ISO time text -> timestamp (UTC wall clock, no zone shift), every event."""
    ev = fx.table(spark, sf_dir, "events")
    txt = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    return ev.select("event_id", txt.alias("time_text"),
                     F.to_timestamp_ntz(txt, F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("time"))


@query("payload_explode", sql=f"""{S.base_ctes()},
days AS (SELECT DISTINCT station, CAST(time AS DATE) AS d FROM air),
grid AS (SELECT station, CAST(d AS TIMESTAMP) + to_hours(CAST(h.range AS BIGINT)) AS time FROM days, range(0, 24) h)
SELECT g.station, g.time, {S.rounded_select(AIR_COLUMNS, [])}
FROM grid g LEFT JOIN air a ON a.station = g.station AND a.time = g.time""")
def payload_explode(spark, sf_dir):
    """Hourly values packed per station-day as API payloads, exploded back to hourly rows."""
    payload = files.hourly_payload(fx.air(spark, sf_dir), AIR_COLUMNS)
    return round_doubles(files.payload_explode(payload, AIR_COLUMNS))


_CHUNK_DAYS = 6
_RANGES = """ranges AS (
  SELECT user_id AS station, CAST(min(ts) AS DATE) AS start_date, CAST(max(ts) AS DATE) AS end_date
  FROM events GROUP BY user_id)"""
_CHUNKS = f"""chunks AS (
  SELECT station, CAST(i AS INTEGER) AS chunk, start_date + CAST(i * {_CHUNK_DAYS + 1} AS INTEGER) AS chunk_start,
         least(start_date + CAST(i * {_CHUNK_DAYS + 1} + {_CHUNK_DAYS} AS INTEGER), end_date) AS chunk_end
  FROM (SELECT station, start_date, end_date,
               unnest(range(0, (end_date - start_date) // {_CHUNK_DAYS + 1} + 1)) AS i FROM ranges))"""


def _chunks(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    ranges = ev.groupBy(F.col("user_id").alias("station")).agg(
        F.to_date(F.min("ts")).alias("start_date"), F.to_date(F.max("ts")).alias("end_date"))
    return files.chunk_table(ranges, _CHUNK_DAYS, keys=["station"])


@query("backfill_chunks", sql=f"""WITH {_RANGES}, {_CHUNKS}
SELECT station, chunk, chunk_start, chunk_end FROM chunks""")
def backfill_chunks(spark, sf_dir):
    """Inclusive back-fill chunks (start + n days, next start = end + 1 day) per station range."""
    return _chunks(spark, sf_dir)


@query("backfill_missing", sql=f"""{S.base_ctes(_RANGES, _CHUNKS)}
SELECT c.station, c.chunk, c.chunk_start, c.chunk_end FROM chunks c
WHERE NOT EXISTS (SELECT 1 FROM air a WHERE a.station = c.station
                  AND CAST(a.time AS DATE) BETWEEN c.chunk_start AND c.chunk_end)""")
def backfill_missing(spark, sf_dir):
    """Chunks whose range has no landed air row (reported instead of silently skipped)."""
    return files.missing_chunks(_chunks(spark, sf_dir), fx.air(spark, sf_dir), keys=["station"])


def _days_before_end(days: int) -> str:
    """Midnight so many days before the last event's day, in SQL."""
    return f"(SELECT date_trunc('day', max(ts)) - INTERVAL {days} DAY FROM events)"


def _day(spark, sf_dir, days: int):
    """The same time as a literal: one number from the data."""
    return F.lit(fx.as_of(spark, sf_dir) - timedelta(days=days - fx.FORECAST_DAYS)).cast("timestamp_ntz")


_HALF_DAYS, _OLD_END_DAYS, _NEW_START_DAYS = 15, 8, 10


@query("union_chunks", sql=f"""{S.base_ctes()}
SELECT station, time, {S.rounded_select(AIR_COLUMNS, [])} FROM air WHERE time < {_days_before_end(_HALF_DAYS)}
UNION ALL
SELECT station, time, {S.rounded_select([c for c in AIR_COLUMNS if c != 'us_aqi'], [])}, NULL AS us_aqi
FROM air WHERE time >= {_days_before_end(_HALF_DAYS)}""")
def union_chunks(spark, sf_dir):
    """An older chunk with every column and a newer fetch without us_aqi, concatenated by name."""
    a = fx.air(spark, sf_dir)
    cut = _day(spark, sf_dir, _HALF_DAYS)
    old = a.where(F.col("time") < cut)
    new = a.where(F.col("time") >= cut).drop("us_aqi")
    return round_doubles(files.union_frames([old, new]))


# ---------------------------------------------------------------- feature store

_OLD_END, _NEW_START = _days_before_end(_OLD_END_DAYS), _days_before_end(_NEW_START_DAYS)


def _store_frames(spark, sf_dir):
    f = base.feature_table(spark, sf_dir).select("station", "time", "pm2_5", "pm10")
    old = f.where(F.col("time") < _day(spark, sf_dir, _OLD_END_DAYS)).withColumn("version", F.lit(1))
    new = f.where(F.col("time") >= _day(spark, sf_dir, _NEW_START_DAYS)).withColumn("version", F.lit(2))
    return old, new


@query("feature_upsert", sql=f"""{S.features_ctes()},
old AS (SELECT station, time, pm2_5, pm10, 1 AS version FROM feat_full WHERE time < {_OLD_END}),
new AS (SELECT station, time, pm2_5, pm10, 2 AS version FROM feat_full WHERE time >= {_NEW_START})
SELECT station, time, {S.rounded_select(['pm2_5', 'pm10'], [])}, version FROM (
  SELECT * FROM new UNION ALL
  SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.station = o.station AND n.time = o.time))""")
def feature_upsert(spark, sf_dir):
    """Keyed upsert of an overlapping batch into a date-partitioned table; last write wins."""
    old, new = _store_frames(spark, sf_dir)
    path = store.table_path(scratch_path(spark, "store"), "aqi_features", 1)
    store.upsert(spark, old, path, ["station", "time"])
    store.upsert(spark, new, path, ["station", "time"])
    return round_doubles(store.read(spark, path).select("station", "time", "pm2_5", "pm10", "version"))


@query("incremental_rows", sql=f"""{S.features_ctes()},
old AS (SELECT * FROM feat_full WHERE time < {_OLD_END}),
new AS (SELECT * FROM feat_full WHERE time >= {_NEW_START})
SELECT station, time, {S.rounded_select(['pm2_5', 'pm10'], [])} FROM new WHERE time > (SELECT max(time) FROM old)""")
def incremental_rows(spark, sf_dir):
    """Rows of a new batch strictly after the stored high-water mark, which the store's statistics give."""
    old, new = _store_frames(spark, sf_dir)
    path = store.table_path(scratch_path(spark, "store"), "aqi_features", 1)
    store.merge(spark, old, path, ["station", "time"]).forget(spark)
    return round_doubles(store.rows_after(new, store.high_water(spark, path)).select("station", "time", "pm2_5", "pm10"))


_STORE_COLS = ["station", "time", *AIR_COLUMNS, *[c for c in WEATHER_RAW_COLUMNS if c != "cloud_cover"], "ozone"]


@query("schema_align", sql=f"""{S.merged_ctes()}
SELECT station, time, {S.rounded_select([c for c in AIR_COLUMNS if c != 'us_aqi'] +
                                         ['temperature_2m', 'precipitation', 'surface_pressure', 'wind_speed_10m'], [])},
  CAST(trunc(coalesce(relative_humidity_2m, 0)) AS BIGINT) AS relative_humidity_2m,
  CAST(trunc(coalesce(wind_direction_10m, 0)) AS BIGINT) AS wind_direction_10m,
  CAST(0.0 AS DOUBLE) AS ozone FROM merged""")
def schema_align(spark, sf_dir):
    """Merged rows shaped like the store: drop us_aqi/cloud_cover, add ozone=0.0, integer humidity/direction."""
    return round_doubles(store.schema_align(base.merged(spark, sf_dir), _STORE_COLS))
