"""The training job (M6, S9-S12, P18, F16): split, fit every candidate, evaluate, append the runs, save, choose, load.

A model store is a folder: ``models/<run>/<name>`` holds each fitted model with its own description (``MultiOutputModel``), ``runs``
is an append-only table with a row for each model of each run (its metrics, the folder of the model, rows trained on), and
``latest`` a JSON record of the last run's best model.  The best model of all runs by any metric and direction is found in
the table and loaded from its folder; nothing but the folder is needed to score with it.

The columns used are written to the shared folder once; the split, the fits and the scoring read that, and all candidates are scored in one pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS, TEST_RATIO, model_features
from aerolith.ml.models import MultiOutputModel, MultiOutputRegressor
from aerolith.operators import evaluation as E
from aerolith.operators.select import dropped, materialised
from aerolith.sources import store

#: The candidates of the reference: name -> kind (its settings are the kinds' defaults).
CANDIDATES = {"linear_regression": {"kind": "linear"}, "random_forest": {"kind": "forest"}, "gradient_boosting": {"kind": "gbt"}}
METRICS = ["mae", "rmse", "r2", "aqi_mae"]


def _root(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def train(table: DataFrame, root: str, candidates: dict[str, dict] | None = None, features: Sequence[str] | None = None,
          targets: Sequence[str] = POLLUTANTS, keys: Sequence[str] = (), time_col: str = "time", tiebreak: Sequence[str] = (),
          test_ratio: float = TEST_RATIO, note: str = "", as_of: datetime | None = None, metric: str = "mae", direction: str = "min") -> DataFrame:
    """One training run on a feature table; returns its rows of the run table (timestamp, run, model_name, metrics, ...).

    The cut is chronological over the whole table (``keys=()``, the reference) or in each key.  ``as_of`` stamps the rows (default: now).
    All five pollutants as ``targets`` also give ``aqi_mae``, else it is NULL.
    """
    spark = table.sparkSession
    features, targets = list(features or model_features()), list(targets)
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    run = uuid.uuid4().hex[:12]
    rows_used = materialised(table.select(*dict.fromkeys([*keys, time_col, *tiebreak, *features, *targets])), "training-table")
    split = E.chrono_split(rows_used, keys, time_col, test_ratio, tiebreak=tiebreak)

    fitted: dict[str, MultiOutputModel] = {}
    scored = split.where("is_test")
    for name, how in (candidates or CANDIDATES).items():
        how = dict(how)
        fitted[name] = MultiOutputRegressor(how.pop("kind"), features, targets, **how).fit(split.where("not is_test"))
        scored = fitted[name].transform(scored).withColumnsRenamed({f"pred_{t}": f"pred_{name}_{t}" for t in targets})
    summary = E.summaries(scored, {m: f"pred_{m}_" for m in fitted}, targets, places=4, index=set(POLLUTANTS) <= set(targets))
    results = {r["model_name"]: r for r in summary.collect()}  # one row a model

    rows = []
    for name, model in fitted.items():
        r = results.get(name)  # none where the test part is empty
        model.metrics = {m: float(r[m]) for m in METRICS if r is not None and r[m] is not None}
        where = _root(root, f"models/{run}/{name}")
        model.write().save(where)
        rows.append((as_of, run, name, model.getOrDefault("kind"), "MULTI_OUTPUT", *[model.metrics.get(m) for m in METRICS], note, where, model.samples, features, targets))
    schema = ("timestamp timestamp_ntz, run string, model_name string, kind string, target string, mae double, rmse double, r2 double, aqi_mae double, "
              "experiment_note string, path string, train_samples long, features array<string>, targets array<string>")
    store.append_history(spark, spark.createDataFrame(rows, schema), _root(root, "runs"))
    dropped(rows_used)
    written = runs(spark, root).where(F.col("run") == run)
    store.write_run_metadata(store.best_by(written, metric, direction), _root(root, "latest"))
    return written


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The run table."""
    return spark.read.parquet(_root(root, "runs"))


def load_best(spark: SparkSession, root: str, metric: str = "mae", direction: str = "min", fallback: str | None = None) -> MultiOutputModel:
    """The best model of all runs by ``metric`` (``min`` or ``max``; ties: name).  Without a run it is the model in the folder ``fallback``."""
    if store.exists(spark, _root(root, "runs")):
        best = store.best_by(runs(spark, root), metric, direction).first()
        if best is not None:
            return MultiOutputModel.load(best["path"])
    if fallback is None:
        raise FileNotFoundError(f"no run with {metric} in {root}")
    return MultiOutputModel.load(fallback)
