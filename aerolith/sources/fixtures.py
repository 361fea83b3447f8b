"""Stand-in hourly tables derived from the driver's ``events`` table.

The reference reads hourly air-quality and weather readings of one site.  The test
data has none, so every query derives them from ``events`` with Spark (the work
grows with ``events``; no event is left out):

* ``station``  = ``user_id``
* ``time``     = ``ts`` truncated to the hour (timestamp_ntz)
* ``c``        = ``value`` in whole cents, ``k`` = integer ``$.k`` of ``props``
* air          = per event type the mean of ``c``/100
* weather      = aggregates of all events of the hour
* forecasting  = only here an ``as_of`` time ends the air table: the start of the day two days
  before the last event, taken from the data; future = weather anti-join that air table

The aggregation is a partial + final hash aggregate over ``(station, hour)``: a hot
station only grows the map-side combine, never one reducer.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from aerolith.functions.timeutil import hour_floor, ntz_lit
from aerolith.operators.select import materialised

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

#: Whole days before the last event's day at which the forecasts' air table ends.
FORECAST_DAYS = 2
# event type -> pollutant column
TYPE_TO_POLLUTANT = {
    "click": "pm2_5",
    "error": "pm10",
    "purchase": "nitrogen_dioxide",
    "signup": "sulphur_dioxide",
    "view": "carbon_monoxide",
}
AIR_COLUMNS = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "us_aqi"]
WEATHER_RAW_COLUMNS = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "surface_pressure",
    "wind_speed_10m", "wind_direction_10m", "cloud_cover",
]


EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])
SCHEMAS = {"events": EVENTS_SCHEMA}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; known schemas are given explicitly (no inference pass)."""
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    """The forecast time: the start of the day ``FORECAST_DAYS`` before the last event's."""
    last = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0] or datetime(1970, 1, 1)
    return last.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=FORECAST_DAYS)


def _events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value", "props")
    return ev.select(
        F.col("user_id").alias("station"),
        hour_floor("ts").alias("time"),
        F.col("ts"),
        F.col("event_type"),
        F.round(F.nanvl(F.col("value"), F.lit(None).cast("double")) * 100).cast("bigint").alias("c"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("k"),
    )


def _mean_cents(cond=None):
    c = F.col("c") if cond is None else F.when(cond, F.col("c"))
    n = F.count(F.lit(1)) if cond is None else F.count_if(cond)
    return F.try_divide(F.sum(c).cast("double"), (n * 100).cast("double"))


def hourly_readings(spark: SparkSession, sf_dir: str, before: datetime | None = None) -> DataFrame:
    """Air and weather aggregates of every (station, hour) in one pass over ``events``.

    ``before`` ends the air readings there (a forecast's ``as_of``); the weather goes on.
    """
    ev = _events_hourly(spark, sf_dir)
    in_time = F.lit(True) if before is None else F.col("ts") < ntz_lit(before)
    n = F.count(F.lit(1))
    air_cols = {pol: _mean_cents(in_time & (F.col("event_type") == t)) for t, pol in TYPE_TO_POLLUTANT.items()}
    return ev.groupBy("station", "time").agg(
        F.count_if(in_time).alias("__n_air"),
        *[air_cols[c].alias(c) for c in AIR_COLUMNS if c != "us_aqi"],
        _mean_cents(in_time).alias("us_aqi"),
        _mean_cents().alias("temperature_2m"),
        (F.sum("k").cast("double") / n.cast("double")).alias("relative_humidity_2m"),
        ((F.max("c") - F.min("c")).cast("double") / F.lit(100.0)).alias("precipitation"),
        (F.lit(1000.0) + F.min("k").cast("double")).alias("surface_pressure"),
        n.cast("double").alias("wind_speed_10m"),
        (F.sum("k") % 360).cast("double").alias("wind_direction_10m"),
        F.max("k").cast("double").alias("cloud_cover"),
    )


def landed(spark: SparkSession, sf_dir: str, before: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """``air`` and ``weather``, both read from one written table of hourly readings: ``events`` is scanned and aggregated once."""
    h = materialised(hourly_readings(spark, sf_dir, before), "hourly")
    return _air(h), _weather(h)


def _air(hourly: DataFrame) -> DataFrame:
    return hourly.where(F.col("__n_air") > 0).select("station", "time", *AIR_COLUMNS)


def _weather(hourly: DataFrame) -> DataFrame:
    return hourly.select("station", "time", *WEATHER_RAW_COLUMNS)


def air_before(air: DataFrame, before: datetime) -> DataFrame:
    """Of an air table without an end, the one that ends at ``before``, a full hour."""
    return air.where(F.col("time") < ntz_lit(before))


def air(spark: SparkSession, sf_dir: str, before: datetime | None = None) -> DataFrame:
    """Hourly pollutant readings per station (up to ``before``, if given)."""
    return _air(hourly_readings(spark, sf_dir, before))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather readings per station, past and forecast hours."""
    return _weather(hourly_readings(spark, sf_dir))


def future_weather(spark: SparkSession, sf_dir: str, before: datetime | None = None) -> DataFrame:
    """Weather hours that have no air row before ``as_of`` (the forecast part, J2)."""
    from aerolith.operators.joins import anti_join_time

    return anti_join_time(weather(spark, sf_dir), air(spark, sf_dir, before or as_of(spark, sf_dir)), ["station"])
