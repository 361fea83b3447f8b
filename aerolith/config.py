"""Column names, fixed parameters and session helpers."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Fixed values (must equal the reference's for equal results).
# Targets in the reference's order.
POLLUTANTS = ["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide"]
# Weather inputs of the model, in the reference's order.
WEATHER_COLS = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "surface_pressure",
    "wind_speed_10m",
    "wind_direction_10m",
]
OPTIONAL_WEATHER_COLS = ["cloud_cover"]
CALENDAR_COLS = ["hour", "day", "month", "day_of_week", "is_weekend"]
LAG_HOURS = [1, 2, 6, 24]
ROLL_HOURS = [6, 24]
TEST_RATIO = 0.2
FORECAST_HORIZON_HOURS = 72
HISTORY_CONTEXT_ROWS = 48


def lag_cols(pollutants=POLLUTANTS, lags=LAG_HOURS):
    return [f"{p}_lag_{k}h" for p in pollutants for k in lags]


def roll_cols(pollutants=POLLUTANTS, widths=ROLL_HOURS):
    return [f"{p}_roll_{s}_{w}h" for p in pollutants for w in widths for s in ("mean", "std")]


def model_features():
    """The 51 model inputs: weather, calendar, lags, rolling stats."""
    return WEATHER_COLS + CALENDAR_COLS + lag_cols() + [
        f"{p}_roll_{s}_{w}h" for p in POLLUTANTS for w in ROLL_HOURS for s in ("mean", "std")
    ]


def get_session(master: str | None = None, app: str = "aerolith", shuffle_partitions: int | None = None):
    """Session with the settings the library expects.

    On a cluster the caller's session already exists and ``getOrCreate`` returns it
    unchanged except for SQL confs we set here (AQE and skew join are on by default
    in Spark 4; they are restated for clarity).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(1)
def _one_machine_dir() -> str:
    return tempfile.mkdtemp(prefix="aerolith-")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables, from ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local master (one process, as in tests) gets a temporary folder; on a cluster there is no
    folder that all executors are known to share, so this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and spark.sparkContext.master.partition("[")[0] == "local":
        d = _one_machine_dir()
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    _scratch.append(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete every path that this process took from ``scratch_path``.  Lazy results that still read them fail afterwards, so call it when they
    are written or collected: at the end of a job."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
