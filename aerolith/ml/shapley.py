"""Attribution of any model by sampled permutations (M8): Shapley values as one Spark job.

For a row and a permutation of the features, a coalition of ``k`` takes the first ``k`` features from the row and the
others from a background row; the feature that joins at step ``k`` earns the change of the prediction.  Averaged over
permutations that is the sampled Shapley value; whatever the sample, contributions + base = prediction on each row
(the steps of a permutation telescope), and for a linear model each permutation gives the exact value.

The job: rows x permutations x steps are exploded inside the task that holds the row (the order comes from a
seeded hash of the row's key, so reruns agree), all coalitions are scored by one ``transform``, and each scored
coalition adds its prediction to the feature that joined last and takes it from the one that joins next.
So no ordering or window is needed: one aggregate by (row, target, feature), combined before the shuffle.
It makes rows x permutations x (features + 1) coalitions: explain a sample of rows (``views.sample_rows``) of large tables.

The background is the row of means of ``rows``, or the rows given (at most MAX_BACKGROUND: they travel with each row);
permutation ``p`` uses the background row ``p`` modulo their number, and the permutations are rounded up to a multiple of
it, so that the base, the mean prediction over the background, is the same for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.stats import _lit, inline_sql

MAX_BACKGROUND = 256


def means(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: the mean of each feature."""
    return rows.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features])


def coalition_order(keep: Sequence[str], n: int, seed: int) -> Column:
    """The permutation ``__perm`` of the row: feature numbers ordered by a seeded hash."""
    drawn = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.struct(F.xxhash64(*[F.col(k) for k in keep], F.col("__perm"), j, F.lit(seed)).alias("h"), j.alias("j")))
    return F.transform(F.array_sort(drawn), lambda s: s["j"])


def sampled_shapley(rows: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], targets: Sequence[str],
                    keep: Sequence[str] = ("station", "time"), background: DataFrame | None = None, permutations: int = 8, seed: int = 42,
                    pred_prefix: str = "pred_") -> DataFrame:
    """keep..., target, feature, value, contribution, base, prediction for every row, target and feature.

    ``keep`` identifies a row.  ``score`` adds ``<pred_prefix><target>`` columns to rows with the ``features`` (a model's ``transform``).
    A missing value stays missing in the coalitions; what it means is up to ``score``.
    """
    keep, features, targets = list(keep), list(features), list(targets)
    n = len(features)
    x = [F.col(f).cast("double") for f in features]
    reference = (means(rows, features) if background is None else background).select(*[c.alias(f) for c, f in zip(x, features, strict=True)])
    count = 1 if background is None else reference.count()
    if not 0 < count <= MAX_BACKGROUND:
        raise ValueError(f"the background has {count} rows; it must have 1 to {MAX_BACKGROUND}")
    permutations = -(-permutations // count) * count
    scored_reference = score(reference)
    one = scored_reference.agg(
        F.collect_list(F.array(*[F.coalesce(F.col(f), F.lit(float("nan"))) for f in features])).alias("__background"),
        *[F.avg(f"{pred_prefix}{t}").alias(f"__base_{t}") for t in targets]).withColumn("__one", F.lit(1))

    # The row's own prediction, its values as an array, and the background (one row, joined on a constant).
    own = score(rows.select(*keep, *[c.alias(f) for c, f in zip(x, features, strict=True)]))
    own = own.select(*keep, F.array(*features).alias("__x"), *[F.col(f"{pred_prefix}{t}").alias(f"__own_{t}") for t in targets], F.lit(1).alias("__one"))
    own = own.join(F.broadcast(one), "__one")

    steps = own.withColumn("__perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    steps = steps.withColumn("__order", coalition_order(keep, n, seed)).withColumn("__b", F.col("__background")[F.col("__perm") % F.lit(count)])
    steps = steps.withColumn("__joins", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.array_position("__order", j))).drop("__background", "__one")
    steps = steps.withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(n))))
    reference_value = lambda j: F.nanvl(F.col("__b")[j], F.lit(None).cast("double"))
    coalitions = steps.withColumns({f: F.when(F.col("__joins")[j] <= F.col("__step"), F.col("__x")[j]).otherwise(reference_value(j)) for j, f in enumerate(features)})
    scored = score(coalitions.drop("__joins", "__b"))

    # The last to join (number __step, from 1) earns the prediction, the next to join gives it up.
    here = scored.select(
        *keep, "__x", *[f"__own_{t}" for t in targets], *[f"__base_{t}" for t in targets], *[f"{pred_prefix}{t}" for t in targets],
        F.explode(F.filter(F.array(
            F.struct(F.get("__order", F.col("__step") - 1).alias("j"), F.lit(1.0).alias("sign")),
            F.struct(F.get("__order", F.col("__step")).alias("j"), F.lit(-1.0).alias("sign"))), lambda e: e["j"].isNotNull())).alias("__e"))
    names = "array(" + ", ".join(_lit(f) for f in features) + ")"
    long = here.select(*keep, inline_sql([[
        (_lit(t), "target"), (f"{names}[__e.j]", "feature"), ("__x[__e.j]", "value"), (f"__e.sign * `{pred_prefix}{t}`", "change"),
        (f"`__base_{t}`", "base"), (f"`__own_{t}`", "prediction")] for t in targets]))
    return long.groupBy(*keep, "target", "feature").agg(
        F.max("value").alias("value"), (F.sum("change") / F.lit(float(permutations))).alias("contribution"), F.max("base").alias("base"),
        F.max("prediction").alias("prediction"))
