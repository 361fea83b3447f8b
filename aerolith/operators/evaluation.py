"""Chronological split and model evaluation.

Predictions stay on the row of their truth (``pred_<target>`` columns), so truth and
prediction never need a positional join (J5, J6).  Metrics unpivot the targets with a
generator and aggregate per target: one partial + final aggregate, five groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS, TEST_RATIO
from aerolith.functions.aqi import overall_aqi, overall_aqi_sql
from aerolith.operators import select
from aerolith.operators.stats import _lit, inline_sql


def chrono_split(df: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                 test_ratio: float = TEST_RATIO, flag: str = "is_test", tiebreak: Sequence[str] = (), strategy: str | None = None) -> DataFrame:
    """The first ``int(n * (1 - test_ratio))`` rows of each key in (time, tiebreak) order train, the rest test; ``keys=()``: of the whole table.

    The cut is computed in doubles, as the reference does.  ``strategy``:

    * ``"select"`` (default without keys): the row at the cut is found by radix selection (``select.row_at``) and rows are compared
      with it: no rank per row, no window, no task that holds a key.  Rows equal in (time, tiebreak) all train or all
      test; a tie-break that tells rows apart makes the cut exact.
    * ``"window"`` (default with keys): positions in a window per key, for keys of bounded length as those of the hourly table.
    """
    keys, order = list(keys), [time_col, *tiebreak]
    cut = F.floor(F.col("__n").cast("double") * F.lit(1.0 - test_ratio)).cast("long")
    if (strategy or ("window" if keys else "select")) == "window":
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        pos = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("__n", n).withColumn("__pos", pos).withColumn(flag, F.col("__pos") > cut).drop("__n", "__pos")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    last = sizes.where("__n > 0").select(*keys, (cut - 1).alias("rank"))  # the last training row; rank -1 where there is none
    found = select.row_at(df, order, last.where("rank >= 0"), keys)
    marks = [f"__k{i}" for i in range(len(order))]
    keyed = select.with_order_keys(df, order)
    if not keys:
        row = found.first()
        is_test = select.after(len(order), [F.lit(row[k]) for k in marks]) if row else F.lit(True)
        return keyed.withColumn(flag, is_test).select(*df.columns, flag)
    found = found.select(*[F.col(k).alias(f"__by_{k}") for k in keys], *[F.col(k).alias(f"__at{i}") for i, k in enumerate(marks)])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__by_{k}"))
    is_test = F.coalesce(select.after(len(order), [F.col(f"__at{i}") for i in range(len(order))]), F.lit(True))
    return keyed.join(found, same, "left").withColumn(flag, is_test).select(*df.columns, flag)


def unpivot_predictions(df: DataFrame, targets: Sequence[str] = POLLUTANTS, pred_prefix: str = "pred_",
                        keep: Sequence[str] = ("station", "time")) -> DataFrame:
    """(keep..., target, actual, predicted) with one row per target."""
    return df.select(*keep, inline_sql([[(_lit(t), "target"), (f"CAST(`{t}` AS DOUBLE)", "actual"),
                                          (f"CAST(`{pred_prefix}{t}` AS DOUBLE)", "predicted")] for t in targets]))


def r2_expr(ss_res, ss_tot):
    """1 - ss_res/ss_tot; a constant truth gives 1.0 for a perfect fit, else 0.0 (scikit-learn)."""
    return F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        F.lit(1.0) - ss_res / ss_tot)


def metrics(df: DataFrame, targets: Sequence[str] = POLLUTANTS, pred_prefix: str = "pred_",
            group: Sequence[str] = ()) -> DataFrame:
    """A8-A10 per target: n, mae, rmse, r2."""
    long = unpivot_predictions(df, targets, pred_prefix, keep=list(group))
    err = F.col("actual") - F.col("predicted")
    agg = long.groupBy(*group, "target").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("__mse"),
        F.sum(err * err).alias("__ss_res"),
        (F.var_pop("actual") * F.count(F.lit(1))).alias("__ss_tot"),
    )
    return agg.select(*group, "target", "n", "mae", F.sqrt("__mse").alias("rmse"),
                      r2_expr(F.col("__ss_res"), F.col("__ss_tot")).alias("r2"))


def aqi_mae(df: DataFrame, pred_prefix: str = "pred_", group: Sequence[str] = ()) -> DataFrame:
    """MAE between the overall index of the truth and of the prediction."""
    truth = overall_aqi()
    pred = overall_aqi(*[f"{pred_prefix}{p}" for p in POLLUTANTS])
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                  F.avg(F.abs(truth - pred).cast("double")).alias("aqi_mae"))


def summaries(df: DataFrame, models: dict[str, str], targets: Sequence[str] = POLLUTANTS,
              places: int = 4, index: bool = True) -> DataFrame:
    """A11 + A12 for several models in one pass.

    ``models`` maps a model name to the prefix of its prediction columns
    (``<prefix><target>``).  Rows are unpivoted to (model, target, actual, predicted)
    by one generator; one aggregation per (model, target) and one per model follow.
    ``index=False`` leaves ``aqi_mae`` NULL (not all pollutants are predicted).
    """
    long = df.select(inline_sql([[(_lit(m), "model_name"), (_lit(t), "target"), (f"CAST(`{t}` AS DOUBLE)", "actual"),
                                  (f"CAST(`{pre}{t}` AS DOUBLE)", "predicted")]
                                 for m, pre in models.items() for t in targets]))
    err = F.col("actual") - F.col("predicted")
    per_target = long.groupBy("model_name", "target").agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        r2_expr(F.sum(err * err), F.var_pop("actual") * F.count(F.lit(1))).alias("r2"))
    avg = per_target.groupBy("model_name").agg(*[F.avg(c).alias(c) for c in ("mae", "rmse", "r2")])
    if not index:
        return avg.select("model_name", *[F.bround(c, places).alias(c) for c in ("mae", "rmse", "r2")], F.lit(None).cast("double").alias("aqi_mae"))
    # The truth's index is one column of the row, and each model's index is computed on its own unpivoted row.
    wide = df.withColumn("__truth", overall_aqi())
    rows = wide.select("__truth", inline_sql([[(_lit(m), "model_name"), *[(f"`{pre}{p}`", f"__p_{p}") for p in POLLUTANTS]]
                                              for m, pre in models.items()]))
    off = F.abs(F.col("__truth") - overall_aqi(*[f"__p_{p}" for p in POLLUTANTS])).cast("double")
    aqi = rows.groupBy("model_name").agg(F.avg(off).alias("aqi_mae"))
    return avg.join(aqi, "model_name").select(
        "model_name", *[F.bround(c, places).alias(c) for c in ("mae", "rmse", "r2", "aqi_mae")])


def residuals(df: DataFrame, targets: Sequence[str] = POLLUTANTS, pred_prefix: str = "pred_",
              keep: Sequence[str] = ("station", "time")) -> DataFrame:
    """(keep..., target, actual, predicted, residual = actual - predicted)."""
    long = unpivot_predictions(df, targets, pred_prefix, keep)
    return long.withColumn("residual", F.col("actual") - F.col("predicted"))


def residual_extremes(df: DataFrame, threshold: float = 20.0, targets: Sequence[str] = POLLUTANTS,
                      pred_prefix: str = "pred_") -> DataFrame:
    """Per target, residuals above +threshold (under-prediction) and below -threshold."""
    r = residuals(df, targets, pred_prefix, keep=())
    return r.groupBy("target").agg(F.count_if(F.col("residual") > threshold).alias("n_under"),
                                   F.count_if(F.col("residual") < -threshold).alias("n_over"))


def residuals_by(df: DataFrame, by, targets: Sequence[str] = POLLUTANTS, pred_prefix: str = "pred_",
                 keep: Sequence[str] = ("station", "time")) -> DataFrame:
    """Residual mean/std/count grouped by an expression of the row (hour, temperature band...)."""
    r = residuals(df.withColumn("__by", by), targets, pred_prefix, keep=[*keep, "__by"])
    return r.groupBy("target", F.col("__by").alias("by")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"),
        F.stddev_samp("residual").alias("std_residual"))
