"""MLlib models: linear fit vs normal equations, attribution invariant, trees, importance, save/load."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.config import scratch_path
from aerolith.ml import explain, models, shapley, training
from aerolith.operators import features
from aerolith.config import POLLUTANTS
from aerolith.operators import views
from aerolith.operators.evaluation import chrono_split, metrics
from aerolith.sources import fixtures as fx

from .conftest import SF_SMALL

FEATS = ["pm2_5_lag_1h", "pm2_5_lag_2h", "temperature_2m", "hour"]


def _table(spark):
    f = features.build_features(fx.air(spark, SF_SMALL), fx.weather(spark, SF_SMALL))
    return chrono_split(f).cache()


def test_linear_matches_least_squares_and_attribution_sums(spark):
    t = _table(spark)
    train = t.where(~F.col("is_test"))
    m = models.fit(train, "linear", features=FEATS, targets=["pm2_5"])
    pdf = train.select(*FEATS, "pm2_5").toPandas()
    x = np.column_stack([pdf[FEATS].to_numpy(float), np.ones(len(pdf))])
    beta = np.linalg.lstsq(x, pdf["pm2_5"].to_numpy(float), rcond=None)[0]
    coefs, inter = models.linear_coefficients(m)
    assert np.allclose([coefs["pm2_5"][f] for f in FEATS], beta[:-1], rtol=1e-6, atol=1e-6)
    assert np.isclose(inter["pm2_5"], beta[-1], rtol=1e-6, atol=1e-6)
    test = m.transform(t.where(F.col("is_test")))
    attr = explain.linear_attribution(test, coefs, inter)
    chk = attr.groupBy("station", "time").agg(
        (F.first("base") + F.sum("contribution")).alias("s"), F.first("prediction").alias("p"))
    d = chk.select(F.max(F.abs(F.col("s") - F.col("p")))).collect()[0][0]
    assert d < 1e-6
    joined = test.select("station", "time", "pred_pm2_5").join(chk, ["station", "time"])
    assert joined.select(F.max(F.abs(F.col("pred_pm2_5") - F.col("p")))).collect()[0][0] < 1e-6


def test_trees_beat_nothing_and_importance(spark):
    t = _table(spark)
    train, test = t.where(~F.col("is_test")), t.where(F.col("is_test"))
    for kind, params in [("forest", dict(numTrees=10, maxDepth=4)), ("gbt", dict(maxIter=5, maxDepth=3))]:
        m = models.fit(train, kind, features=FEATS, targets=["pm2_5"], **params)
        r = metrics(m.transform(test), ["pm2_5"]).collect()[0]
        assert r["n"] > 0 and np.isfinite(r["mae"])
        imp = explain.feature_importance(m.models["pm2_5"].stages[-1], FEATS, spark).collect()
        assert len(imp) == len(FEATS) and abs(sum(x.importance for x in imp) - 1.0) < 1e-6
    path = scratch_path(spark, "model")
    m.save(path)
    back = models.MultiOutputModel.load(path)
    assert back.feature_list == FEATS and back.getOrDefault("kind") == "gbt" and back.samples == m.samples
    a = m.transform(test).select("station", "time", "pred_pm2_5").collect()
    b = back.transform(test).select("station", "time", "pred_pm2_5").collect()
    assert sorted(a) == sorted(b)


LAGS = [f"{p}_lag_1h" for p in POLLUTANTS]
CANDIDATES = {"linear": {"kind": "linear"}, "ridge": {"kind": "linear", "regParam": 5.0}, "forest": {"kind": "forest", "numTrees": 8, "maxDepth": 4},
              "boosting": {"kind": "gbt", "maxIter": 4, "maxDepth": 2}}


def _features(spark):
    return features.build_features(fx.air(spark, SF_SMALL), fx.weather(spark, SF_SMALL))


def test_training_job_end_to_end(spark):
    """Fit all kinds, evaluate, append, save, load the best by metric and direction, score."""
    table, root = _features(spark), scratch_path(spark, "t-models")
    inputs = [*LAGS, "temperature_2m", "hour"]
    first = training.train(table, root, CANDIDATES, inputs, tiebreak=["station"], note="first")
    rows = {r.model_name: r for r in first.collect()}
    assert set(rows) == set(CANDIDATES) and all(r.features == inputs and r.targets == POLLUTANTS for r in rows.values())
    n = table.count()
    assert all(r.train_samples == int(n * 0.8) for r in rows.values())

    # Against persistence (the last hour's value, often the very reading, as gaps are filled forward) on the same test rows.
    test = chrono_split(table, (), tiebreak=["station"]).where("is_test").withColumns({f"pred_{p}": F.col(f"{p}_lag_1h") for p in POLLUTANTS})
    persistence = metrics(test).agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse")).first()
    assert all(rows[m].rmse < persistence.rmse for m in ("linear", "ridge"))
    assert all(r.rmse < 1.1 * persistence.rmse and r.r2 > 0.45 for r in rows.values())

    training.train(table, root, {"linear": {"kind": "linear"}}, ["hour"], tiebreak=["station"], note="second")
    runs = training.runs(spark, root).collect()
    assert len(runs) == 5 and {r.experiment_note for r in runs} == {"first", "second"} and len({r.run for r in runs}) == 2
    for metric, direction, choose in (("mae", "min", min), ("r2", "max", max)):
        want = choose(sorted(runs, key=lambda r: r.model_name), key=lambda r: r[metric])
        best = training.load_best(spark, root, metric, direction)
        assert best.metrics[metric] == want[metric] and best.feature_list == want.features and best.samples == want.train_samples
    record = json.loads("".join(r.value for r in spark.read.text(f"{root}/latest").collect()))
    assert record["model_name"] == "linear" and record["features"] == ["hour"] and record["timestamp"]

    scored = best.transform(table.select("station", "time", *best.feature_list[:3]))  # missing columns are 0.0
    assert scored.where(" OR ".join(f"pred_{p} IS NULL" for p in POLLUTANTS)).isEmpty() and scored.count() == n


def test_load_without_a_run_falls_back(spark):
    root = scratch_path(spark, "t-none")
    with pytest.raises(FileNotFoundError):
        training.load_best(spark, root)
    m = models.fit(_features(spark), "linear", ["hour"], ["pm2_5"])
    m.save(f"{root}/local")
    assert training.load_best(spark, root, fallback=f"{root}/local").feature_list == ["hour"]


def test_rows_with_missing_values_are_not_learnt_from(spark):
    rows = [(float(i), 2.0 * i + 1) for i in range(40)] + [(None, 500.0)] * 5 + [(3.0, None)] * 5
    m = models.fit(spark.createDataFrame(rows, "x double, y double"), "linear", ["x"], ["y"])
    coefs, inter = models.linear_coefficients(m)
    assert m.samples == 40 and np.isclose(coefs["y"]["x"], 2.0) and np.isclose(inter["y"], 1.0)


def test_ridge_matches_its_normal_equations(spark):
    """N6 without standardization: mean squared error / 2 + regParam / (2 * deviation of the label) * |w|^2 (MLlib's scale), the intercept free."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3)) * [1.0, 4.0, 0.5]
    y = x @ [2.0, -1.0, 0.5] + 3 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    lam = 0.7
    m = models.fit(df, "linear", ["a", "b", "c"], ["y"], regParam=lam, standardization=False)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc / 200 + lam / y.std() * np.eye(3), xc.T @ yc / 200)
    coefs, inter = models.linear_coefficients(m)
    assert np.allclose([coefs["y"][c] for c in "abc"], want, rtol=1e-6) and np.isclose(inter["y"], y.mean() - x.mean(0) @ want)
    plain, _ = models.linear_coefficients(models.fit(df, "linear", ["a", "b", "c"], ["y"]))
    assert sum(v * v for v in coefs["y"].values()) < sum(v * v for v in plain["y"].values())


def test_sampled_attribution_of_trees_sums_to_the_prediction(spark):
    table = _features(spark)
    targets = ["pm2_5", "pm10"]
    m = models.fit(table, "forest", FEATS, targets, numTrees=6, maxDepth=4)
    rows = views.sample_rows(table, 20).select("station", "time", *FEATS)
    for background in (None, views.sample_rows(table, 5, seed=1).select(*FEATS)):
        a = shapley.sampled_shapley(rows, m.transform, FEATS, targets, background=background, permutations=6).toPandas()
        assert len(a) == 20 * len(FEATS) * 2
        total = a.groupby(["station", "time", "target"]).agg(s=("contribution", "sum"), base=("base", "first"), p=("prediction", "first"))
        assert np.allclose(total.s + total.base, total.p)
        want = m.transform(rows).toPandas().set_index(["station", "time"])
        assert np.allclose([want.loc[(s, t), f"pred_{k}"] for s, t, k in total.index], total.p)
    again = shapley.sampled_shapley(rows, m.transform, FEATS, targets, background=background, permutations=6).toPandas()
    key = ["station", "time", "target", "feature"]
    assert np.allclose(a.sort_values(key).contribution, again.sort_values(key).contribution)


def test_sampled_attribution_tends_to_the_exact_one(spark):
    """A product of two inputs and an unused third: the exact Shapley values by all orders."""
    from itertools import permutations

    df = spark.createDataFrame([(i, float(i), float(i * i % 7), float(i % 3)) for i in range(6)], "id long, a double, b double, c double")
    score = lambda d: d.withColumn("pred_y", F.col("a") * F.col("b") + F.col("a"))
    got = {(r.id, r.feature): r for r in shapley.sampled_shapley(df, score, ["a", "b", "c"], ["y"], keep=["id"], permutations=400).collect()}
    pdf = df.toPandas()
    mean = pdf[["a", "b", "c"]].mean().to_dict()
    f = lambda v: v["a"] * v["b"] + v["a"]
    for row in pdf.to_dict("records"):
        exact = dict.fromkeys("abc", 0.0)
        for order in permutations("abc"):
            v = dict(mean)
            for k in order:
                before = f(v)
                v[k] = row[k]
                exact[k] += (f(v) - before) / 6
        for k in "abc":
            assert abs(got[row["id"], k].contribution - exact[k]) < 0.8 and got[row["id"], k].value == row[k]
        assert np.isclose(sum(got[row["id"], k].contribution for k in "abc") + got[row["id"], "a"].base, f(row))
        assert got[row["id"], "c"].contribution == 0
    with pytest.raises(ValueError):
        shapley.sampled_shapley(df, score, ["a", "b", "c"], ["y"], keep=["id"], background=df.where("false"))


def test_linear_fits_of_all_targets_share_one_pass(spark, monkeypatch):
    """Each target is fitted on few rows with the moments of all; the models are MLlib's on the rows themselves."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 3)) * [1.0, 40.0, 1e-3] + [0.0, 1000.0, 5.0]
    y = x @ rng.normal(size=(3, 5)) + rng.normal(size=(3000, 5)) + 7
    columns = ["a", "b", "c", "fixed", *POLLUTANTS]
    df = spark.createDataFrame([(*map(float, p), 0.1, *map(float, q)) for p, q in zip(x, y, strict=True)], ", ".join(f"{c} double" for c in columns)).repartition(7)
    seen = []

    class Counted(models.Pipeline):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    def both(rows, **settings):
        monkeypatch.setattr(models, "Pipeline", Counted)
        coefs, inter = models.linear_coefficients(models.fit(rows, "linear", columns[:3], **settings))
        monkeypatch.undo()
        for t in POLLUTANTS:
            stages = [models.VectorAssembler(inputCols=columns[:3], outputCol=models.FEATURES_COL), models.estimator("linear", t, f"pred_{t}", **settings)]
            want = models.Pipeline(stages=stages).fit(rows).stages[-1]
            assert np.allclose([coefs[t][f] for f in columns[:3]], want.coefficients.toArray(), rtol=1e-5) and np.isclose(inter[t], want.intercept, rtol=1e-5)

    both(df)
    assert len(seen) == 5 and max(seen) <= 2 * len(columns)
    both(df, regParam=0.3)
    both(spark.createDataFrame(df.take(9), df.schema))  # not more rows than columns and one: the rows themselves
    assert seen[-1] == 9
    n, rows = models.moment_rows(df, columns)
    got, want = np.array(rows), df.toPandas()[columns].to_numpy()
    assert n == 3000 and np.allclose(got.mean(0), want.mean(0), rtol=1e-12) and np.allclose(np.cov(got.T, bias=True), np.cov(want.T, bias=True), rtol=1e-9, atol=1e-11)
    assert set(got[:, 3]) == {0.1} and models.moment_rows(df.where("a > 100"), columns) == (0, [])


def test_infinite_values_are_left_to_mllib(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(50)] + [(float("inf"), 1.0)], "x double, y double")
    seen = []
    monkeypatch.setattr(models.Pipeline, "_fit", lambda self, rows: seen.append(rows.count()) or models.PipelineModel([]))
    assert models.fit(df, "linear", ["x"], ["y"]).samples == 51 and seen == [51]
