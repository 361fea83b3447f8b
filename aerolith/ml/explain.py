"""Feature attribution and importance.

Exact additive attribution of a linear model as Column arithmetic:
``contribution_j = coef_j * (x_j - mean_j)`` and ``base = intercept + sum_j coef_j * mean_j``,
so ``base + sum_j contribution_j = prediction`` on every row (the linear-model case of
Shapley values with the data mean as background).  Means come from one global
aggregate (one row, broadcast through a constant equi-join); rows then unpivot to
(target, feature, value, contribution) with a generator.  No per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def linear_attribution(df: DataFrame, coefs: dict[str, dict[str, float]], intercepts: dict[str, float] | None = None,
                       keep: Sequence[str] = ("station", "time")) -> DataFrame:
    """Long form (keep..., target, feature, value, contribution, base, prediction) for every row and target."""
    intercepts = intercepts or {}
    feats = sorted({f for c in coefs.values() for f in c})
    means = df.agg(*[F.avg(F.col(f).cast("double")).alias(f"__mean_{f}") for f in feats]).withColumn("__g", F.lit(0))
    j = df.withColumn("__g", F.lit(0)).join(F.broadcast(means), "__g")
    structs = []
    for t, c in coefs.items():
        base = F.lit(float(intercepts.get(t, 0.0)))
        pred = F.lit(float(intercepts.get(t, 0.0)))
        for f, w in c.items():
            base = base + F.lit(float(w)) * F.col(f"__mean_{f}")
            pred = pred + F.lit(float(w)) * F.col(f).cast("double")
        for f, w in c.items():
            structs.append(F.struct(
                F.lit(t).alias("target"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                (F.lit(float(w)) * (F.col(f).cast("double") - F.col(f"__mean_{f}"))).alias("contribution"),
                base.alias("base"), pred.alias("prediction")))
    return j.select(*keep, F.inline(F.array(*structs)))


def attribution_summary(attr: DataFrame, top: int = 15) -> DataFrame:
    """A17 + O5: mean |contribution| per (target, feature), the ``top`` largest per target.

    One grouped aggregate, then a per-target top-k window over the small
    (targets x features) result.
    """
    s = attr.groupBy("target", "feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    w = Window.partitionBy("target").orderBy(F.col("mean_abs").desc(), F.col("feature"))
    return s.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= top)


def waterfall(attr: DataFrame, row_filter, target: str) -> DataFrame:
    """M9: one row's contributions for ``target`` ordered by |contribution| with the running total from the base."""
    r = attr.where(row_filter & (F.col("target") == target))
    w = Window.partitionBy("target").orderBy(F.abs("contribution").desc(), F.col("feature"))
    r = r.withColumn("step", F.row_number().over(w).cast("int"))
    run = F.sum("contribution").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return r.withColumn("cumulative", F.col("base") + run)


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    """M7: ``featureImportances`` of a tree model as a ranked DataFrame (features x 1, small)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.withColumn("rank", F.row_number().over(w).cast("int"))
