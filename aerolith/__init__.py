"""aerolith: Spark-native operators for hourly sensor (air-quality and weather) series.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
native Column expressions, windows, joins and aggregations, so Catalyst plans
and partitions the work.  Ordered operators take ``keys`` (station columns);
``keys=[]`` is a single series.
"""

from aerolith.config import (  # noqa: F401
    LAG_HOURS,
    POLLUTANTS,
    ROLL_HOURS,
    WEATHER_COLS,
    checkpoint_dir,
    get_session,
)

__version__ = "0.1.0"
