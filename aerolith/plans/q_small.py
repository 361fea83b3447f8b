"""Registered queries of small operators that others use without showing them: sinks, head, zones, defaults."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from aerolith.config import POLLUTANTS, scratch_path
from aerolith.functions.timeutil import as_ntz
from aerolith.operators import clean
from aerolith.plans import q_views as QV
from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import files
from aerolith.sources import fixtures as fx


@query("predictions_csv", sql=f"""{QV._CTES}
SELECT station, time, {S.rounded_select([f'pred_{p}' for p in POLLUTANTS], [])}, CAST(us_epa_aqi AS DOUBLE) AS us_epa_aqi FROM preds""")
def predictions_csv(spark, sf_dir):
    """The forecast written as CSV with a header and read back; times as text, missing values as empty cells."""
    path = scratch_path(spark, "predictions")
    columns = ["station", "time", *[f"pred_{p}" for p in POLLUTANTS], "us_epa_aqi"]
    out = QV.predictions(spark, sf_dir).select(*columns).withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    out.write.option("header", True).csv(path)
    schema = StructType([StructField("station", LongType()), StructField("time", TimestampNTZType()), *[StructField(c, DoubleType()) for c in columns[2:]]])
    return round_doubles(files.read_csv(spark, path, schema, "yyyy-MM-dd HH:mm:ss"))


@query("head_rows", sql=f"""{S.base_ctes()}
SELECT station, time, {S.r6('temperature_2m', 'temperature_2m')} FROM weather ORDER BY time, station LIMIT 5""")
def head_rows(spark, sf_dir):
    """O3, O1: the first five weather hours by time (ties by station), a top-k and no sort of the table."""
    w = fx.weather(spark, sf_dir).select("station", "time", "temperature_2m")
    return round_doubles(w.orderBy("time", "station").limit(5))


@query("drop_zone", sql="SELECT event_id, ts - INTERVAL 5 HOUR AS utc FROM events")
def drop_zone(spark, sf_dir):
    """Times of a zone five hours east of Greenwich made UTC and freed from their zone, of every event."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", as_ntz(F.to_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Karachi")).alias("utc"))


@query("model_input", sql=f"""{S.base_ctes()}
SELECT station, time, {', '.join(S.r6(f'coalesce({p}, 0)', p) for p in POLLUTANTS)}, {S.r6('coalesce(us_aqi, 0)', 'aqi')},
  CAST(0 AS DOUBLE) AS ozone, {S.r6('coalesce(pm10, 0)', 'dust')} FROM air""")
def model_input(spark, sf_dir):
    """Model inputs with missing values as 0.0; a column by its name, another's in its place, or a default."""
    a = clean.fill_zero(fx.air(spark, sf_dir), [*POLLUTANTS, "us_aqi"])
    return round_doubles(a.select("station", "time", *POLLUTANTS, clean.column_or(a, "us_aqi", default=0.0).alias("aqi"),
                                  clean.column_or(a, "ozone", default=0.0).alias("ozone"), clean.column_or(a, "dust", "pm10").alias("dust")))
