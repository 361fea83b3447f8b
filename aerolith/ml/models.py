"""Multi-output regression with MLlib (M2-M6): an estimator, its model, and their files.

The reference fits one multi-output model; MLlib estimators take one label, so ``MultiOutputRegressor`` fits one
``VectorAssembler`` + regressor pipeline per target, submitted from a small driver thread pool.  Trees read one materialised frame:
the rows without a missing feature or target are written to the shared folder once.  Least squares and ridge depend on the rows only
by their means and covariances, so one pass over the rows serves all targets: each task reduces its rows to the triangular factor of a QR
decomposition, the factors are merged pairwise, and the linear regressors are fitted on a few rows with the same means and
covariances (``moment_rows``; the training summary of such a regressor describes those).
Predictions are added as ``pred_<target>`` columns on the scored rows (no positional glue, J5).

A saved model holds its own description: kind, settings, features in their order, targets and the metrics of its evaluation
(the estimator's params in the metadata file of ``pyspark.ml``), and a pipeline for each target.  So loading needs a path only.

Settings of the reference: forest 100 trees depth 10 seed 42; boosting 100 rounds, depth 6, rate 0.1.  They are the
defaults here; tests use small settings.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from aerolith.config import POLLUTANTS, model_features, scratch_path
from aerolith.functions.aqi import pm25_forecast_index
from aerolith.operators.clean import drop_any_null, fill_zero
from aerolith.sources.store import delete

FEATURES_COL = "__features"


def estimator(kind: str, label: str, pred: str, **params):
    if kind == "linear":  # M2 (N6 ridge with regParam > 0)
        return LinearRegression(featuresCol=FEATURES_COL, labelCol=label, predictionCol=pred,
                                regParam=params.get("regParam", 0.0), elasticNetParam=0.0,
                                standardization=params.get("standardization", True),
                                solver=params.get("solver", "normal"))
    if kind == "forest":  # M3
        return RandomForestRegressor(featuresCol=FEATURES_COL, labelCol=label, predictionCol=pred,
                                     numTrees=params.get("numTrees", 100), maxDepth=params.get("maxDepth", 10),
                                     seed=params.get("seed", 42))
    if kind == "gbt":  # M4
        return GBTRegressor(featuresCol=FEATURES_COL, labelCol=label, predictionCol=pred,
                            maxIter=params.get("maxIter", 100), maxDepth=params.get("maxDepth", 6),
                            stepSize=params.get("stepSize", 0.1), seed=params.get("seed", 42))
    raise ValueError(f"unknown model kind {kind!r}")


def moment_rows(rows: DataFrame, columns: Sequence[str]) -> tuple[int, list[list[float]]]:
    """How many ``rows`` there are, and few rows with the same means and covariances (divided by n) of ``columns``, numbers that are all there.

    Rows that are not more than the columns and one stay as they are.  Else the rows, with a first column of ones, have the factor R: its first line
    gives the means, the others the k lines of a matrix D with D'D the sum of squares and products about the means, and the 2 k
    rows mean + sqrt(k/n) D and mean - sqrt(k/n) D have the same moments.  A column of one value keeps exactly that value.
    A task sends one matrix, whatever its rows, and the matrices are merged in a tree.
    """
    import numpy as np

    width = len(columns) + 1

    def reduced(m):
        """Rows with the same sums of squares and products; at most as many as columns."""
        return np.linalg.qr(m, mode="r") if len(m) > width else m

    def merged(a, b):
        """Of two parts of the rows: their number, and a matrix of the columns' least values, greatest values, and reduced rows."""
        (n, x), (m, y) = a, b
        return n + m, np.vstack([np.minimum(x[:1], y[:1]), np.maximum(x[1:2], y[1:2]), reduced(np.vstack([x[2:], y[2:]]))])

    none = 0, np.vstack([np.full((1, width), np.inf), np.full((1, width), -np.inf), np.empty((0, width))])

    def parts(batches):
        import pyarrow as pa

        part = none
        for b in batches:
            if b.num_rows:
                x = np.column_stack([np.ones(b.num_rows), *[c.to_numpy(zero_copy_only=False) for c in b.columns]])
                part = merged(part, (len(x), np.vstack([x.min(axis=0), x.max(axis=0), x])))
        yield pa.RecordBatch.from_pydict({"n": [part[0]], "m": [part[1].tobytes()]})

    each = rows.select(*[F.col(f"`{c}`").cast("double") for c in columns]).mapInArrow(parts, "n long, m binary").rdd
    n, m = each.map(lambda r: (r.n, np.frombuffer(bytes(r.m)).reshape(-1, width))).treeAggregate(none, merged, merged)
    least, most, m = m[0, 1:], m[1, 1:], m[2:]
    if n <= width:
        return n, m[:, 1:].tolist()
    mean, off = m[0, 1:] / m[0, 0], m[1:, 1:] * np.sqrt((width - 1) / n)
    mean, off = np.where(least == most, least, mean), np.where(least == most, 0.0, off)
    return n, np.vstack([mean + off, mean - off]).tolist()


class _Described(Params):
    """What both the estimator and its model know."""

    kind = Param(Params._dummy(), "kind", "linear, forest or gbt", typeConverter=TypeConverters.toString)
    features = Param(Params._dummy(), "features", "the inputs, in their order", typeConverter=TypeConverters.toListString)
    targets = Param(Params._dummy(), "targets", "the outputs", typeConverter=TypeConverters.toListString)
    settings = Param(Params._dummy(), "settings", "the regressor's settings as JSON", typeConverter=TypeConverters.toString)


class MultiOutputRegressor(Estimator, _Described, MLWritable, MLReadable):
    """M2-M4: one regressor per target.  Rows with a missing feature or target are not learnt from (P10)."""

    def __init__(self, kind: str = "linear", features: Sequence[str] | None = None, targets: Sequence[str] = POLLUTANTS, parallel: int = 5, **settings):
        super().__init__()
        self.parallel = parallel
        self._set(kind=kind, features=list(features or model_features()), targets=list(targets), settings=json.dumps(settings, sort_keys=True))

    def _fit(self, dataset: DataFrame) -> "MultiOutputModel":
        kind, features, targets = self.getOrDefault("kind"), self.getOrDefault("features"), self.getOrDefault("targets")
        settings = json.loads(self.getOrDefault("settings"))
        spark = dataset.sparkSession
        complete = drop_any_null(dataset.select(*dict.fromkeys([*features, *targets])))

        def fitted(rows):
            def one(t):
                stages = [VectorAssembler(inputCols=features, outputCol=FEATURES_COL), estimator(kind, t, f"pred_{t}", **settings)]
                return Pipeline(stages=stages).fit(rows)

            with ThreadPoolExecutor(max_workers=max(1, self.parallel)) as pool:
                return dict(zip(targets, pool.map(one, targets), strict=True))

        if kind == "linear" and settings.get("solver", "normal") == "normal" and all(isinstance(f.dataType, (NumericType, BooleanType)) for f in complete.schema):
            samples, few = moment_rows(complete, complete.columns)
            if all(math.isfinite(x) for row in few for x in row):  # else MLlib decides what infinite values come to
                schema = ", ".join(f"`{c}` double" for c in complete.columns)
                return self._copyValues(MultiOutputModel(fitted(spark.createDataFrame(few, schema).coalesce(1)), samples))
        path = scratch_path(spark, "training")
        complete.write.parquet(path)
        rows = spark.read.parquet(path)
        model = MultiOutputModel(fitted(rows), rows.count())
        delete(spark, path)
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class MultiOutputModel(Model, _Described, MLWritable, MLReadable):
    """One fitted pipeline per target with the feature list it was trained on (P18, D10) and the metrics of its evaluation."""

    def __init__(self, models: dict[str, PipelineModel] | None = None, samples: int = 0, metrics: dict[str, float] | None = None):
        super().__init__()
        self.models, self.samples, self.metrics = models or {}, samples, metrics or {}

    @property
    def feature_list(self) -> list[str]:
        return self.getOrDefault("features")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """M5: add ``pred_<target>``; a missing input, column or value, is 0.0 (P6, P8) as the reference has it at prediction time."""
        features = self.getOrDefault("features")
        x = dataset.withColumns({f: F.lit(0.0) for f in features if f not in dataset.columns})
        x = fill_zero(x, features)
        for m in self.models.values():
            x = m.transform(x).drop(FEATURES_COL)
        return x

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    """The metadata file, and an MLWriter directory per target."""

    def __init__(self, model: MultiOutputModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        more = {"metrics": self.model.metrics, "samples": self.model.samples}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=more)
        for t, m in self.model.models.items():
            m.write().save(f"{path.rstrip('/')}/target={t}")


class _ModelReader(MLReader):
    def load(self, path: str) -> MultiOutputModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        targets = meta["paramMap"]["targets"]
        model = MultiOutputModel({t: PipelineModel.load(f"{path.rstrip('/')}/target={t}") for t in targets}, meta["samples"], meta["metrics"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def fit(train: DataFrame, kind: str = "linear", features: Sequence[str] | None = None, targets: Sequence[str] = POLLUTANTS, parallel: int = 5,
        **settings) -> MultiOutputModel:
    """M2-M4 in one call."""
    return MultiOutputRegressor(kind, features, targets, parallel, **settings).fit(train)


def score_forecast(model: MultiOutputModel, future_features: DataFrame) -> DataFrame:
    """M5 + F12: predictions for the future hours with the PM2.5 forecast index."""
    p = model.transform(future_features)
    return p.withColumn("us_epa_aqi", pm25_forecast_index("pred_pm2_5"))


def linear_coefficients(model: MultiOutputModel) -> tuple[dict, dict]:
    """Coefficients and intercepts of fitted linear pipelines (for exact attribution)."""
    coefs, inter = {}, {}
    for t, pm in model.models.items():
        lr = pm.stages[-1]
        coefs[t] = dict(zip(model.feature_list, [float(v) for v in lr.coefficients.toArray()], strict=True))
        inter[t] = float(lr.intercept)
    return coefs, inter
