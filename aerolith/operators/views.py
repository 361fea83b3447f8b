"""Presentation tables of the forecast and the run history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS
from aerolith.functions import aqi as A
from aerolith.functions.timeutil import ntz_lit


def forecast_view(pred: DataFrame, as_of, time_col: str = "time") -> DataFrame:
    """Forecast rows at or after ``as_of`` (a parameter, never ``now()`` inside the plan).
    The predicate is a plain column comparison, so it reaches the Parquet scan / partition filter."""
    return pred.where(F.col(time_col) >= ntz_lit(as_of))


def current_status(pred: DataFrame, as_of, keys: Sequence[str] = ("station",), time_col: str = "time",
                   aqi_col: str = "us_epa_aqi") -> DataFrame:
    """O4 + F13 + P16: the first forecast row at/after ``as_of`` per key with its status and alert flag.

    ``min_by`` over a struct is a grouped aggregate: partially aggregated map-side, so a
    hot key never gathers its rows in one task.
    """
    v = forecast_view(pred, as_of, time_col)
    rest = [c for c in v.columns if c not in keys]
    first = v.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(time_col)).alias("__r"))
    out = first.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
    return out.withColumn("status", A.status(aqi_col)).withColumn("alert", A.is_alert(aqi_col))


def alerts(pred: DataFrame, as_of, aqi_col: str = "us_epa_aqi", threshold: float = A.ALERT_THRESHOLD) -> DataFrame:
    """Forecast hours whose index is above the alert threshold."""
    return forecast_view(pred, as_of).where(A.is_alert(aqi_col, threshold))


def pollutant_stack(pred: DataFrame, keys: Sequence[str] = ("station", "time"),
                    targets: Sequence[str] = POLLUTANTS, pred_prefix: str = "pred_") -> DataFrame:
    """Stacked-area input: per row and pollutant (fixed order) the value and the running total.

    The running total runs across the five columns of one row, so it is a column
    expression, not a window: no shuffle.
    """
    structs, run = [], None
    for i, t in enumerate(targets):
        v = F.col(f"{pred_prefix}{t}").cast("double")
        run = v if run is None else run + v
        structs.append(F.struct(F.lit(i).alias("level"), F.lit(t).alias("target"), v.alias("value"),
                                run.alias("stacked")))
    return pred.select(*keys, F.inline(F.array(*structs)))


def leaderboard(runs: DataFrame, metric: str = "mae", flag_cols: Sequence[str] = ("mae", "aqi_mae"),
                name_col: str = "model_name") -> DataFrame:
    """Runs sorted by ``metric`` with the column minima flagged.

    The minima come from one global aggregate (one row) joined on a constant.
    """
    mins = runs.agg(*[F.min(c).alias(f"__min_{c}") for c in flag_cols]).withColumn("__g", F.lit(0))
    j = runs.withColumn("__g", F.lit(0)).join(F.broadcast(mins), "__g")
    flagged = j.select("experiment_note", name_col, *flag_cols,
                       *[(F.col(c) == F.col(f"__min_{c}")).alias(f"best_{c}") for c in flag_cols])
    return flagged.orderBy(metric, name_col)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key_cols: Sequence[str] = ("station", "time")) -> DataFrame:
    """Deterministic sample of ``min(n, rows)`` rows: the ``n`` smallest MD5 digests of the seed and the key's text.

    A top-k (``TakeOrderedAndProject``): each task keeps its ``n`` best rows, the driver
    merges ``tasks x n`` rows; the limit is the feature (a fixed-size sample).
    """
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))
    return df.withColumn("__h", drawn).orderBy("__h", *key_cols).limit(n).drop("__h")
