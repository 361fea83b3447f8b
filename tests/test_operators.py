"""Window, join, statistics and evaluation operators against hand-computed values and pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolith.config import POLLUTANTS
from aerolith.operators import evaluation as E
from aerolith.operators import features, stats, windows
from aerolith.operators import forecast as FC
from aerolith.plans import q_forecast as QF
from aerolith.sources import fixtures as fx

T0 = datetime(2024, 1, 1)


def _series(spark, values, station=0, step_h=1):
    rows = [(station, T0 + timedelta(hours=i * step_h), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station long, time timestamp_ntz, pm2_5 double")


def test_ffill_literal(spark):
    df = _series(spark, [None, 1.0, None, 3.0])
    for strategy in ("plain", "blocked"):
        got = [r.pm2_5 for r in windows.ffill(df, ["pm2_5"], strategy=strategy).orderBy("time").collect()]
        assert got == [None, 1.0, 1.0, 3.0]


def test_rolling_std_one_earlier_value(spark):
    df = _series(spark, [5.0, 7.0])
    r = windows.rolling_features(df, ["pm2_5"], [6], strategy="plain").orderBy("time").collect()
    assert r[0]["pm2_5_roll_mean_6h"] is None and r[0]["pm2_5_roll_std_6h"] == 0.0
    assert r[1]["pm2_5_roll_mean_6h"] == 5.0 and r[1]["pm2_5_roll_std_6h"] == 0.0


def test_lag_rolling_match_pandas(spark):
    rng = np.random.default_rng(7)
    vals = [None if rng.random() < 0.3 else float(rng.integers(0, 500)) / 10 for _ in range(300)]
    df = _series(spark, vals)
    got = (windows.lag_and_rolling(df, ["pm2_5"], strategy="blocked", block_rows=50)
           .orderBy("time").toPandas())
    s = pd.Series(vals, dtype="float64")
    for k in (1, 2, 6, 24):
        assert np.allclose(got[f"pm2_5_lag_{k}h"], s.shift(k), equal_nan=True)
    for n in (6, 24):
        assert np.allclose(got[f"pm2_5_roll_mean_{n}h"], s.shift(1).rolling(n, min_periods=1).mean(), equal_nan=True)
        assert np.allclose(got[f"pm2_5_roll_std_{n}h"], s.shift(1).rolling(n, min_periods=1).std().fillna(0),
                           equal_nan=True)


def test_blocked_equals_plain_with_gaps_and_keys(spark):
    rng = np.random.default_rng(3)
    rows = []
    for st in range(3):
        t = T0
        for _ in range(400):
            t += timedelta(hours=int(rng.integers(1, 30)))
            rows.append((st, t, None if rng.random() < 0.4 else float(rng.random())))
    df = spark.createDataFrame(rows, "station long, time timestamp_ntz, pm2_5 double")
    a = windows.lag_and_rolling(df, ["pm2_5"], strategy="plain").orderBy("station", "time").toPandas()
    b = windows.lag_and_rolling(df, ["pm2_5"], strategy="blocked", block_rows=64).orderBy("station", "time").toPandas()
    assert a.shape == b.shape
    for c in a.columns[3:]:
        assert np.allclose(a[c].astype(float), b[c].astype(float), equal_nan=True), c
    fa = windows.ffill(df, ["pm2_5"], strategy="plain").orderBy("station", "time").toPandas()
    fb = windows.ffill(df, ["pm2_5"], strategy="blocked", block_rows=50) \
        .orderBy("station", "time").toPandas()
    assert np.allclose(fa.pm2_5.astype(float), fb.pm2_5.astype(float), equal_nan=True)


def test_blocked_plan_has_no_single_partition_exchange(spark):
    df = _series(spark, [float(i) for i in range(100)])
    plan = windows.lag_and_rolling(df, ["pm2_5"], keys=[], strategy="blocked")._jdf.queryExecution() \
        .executedPlan().toString()
    # The rows are never gathered in one partition: a SinglePartition exchange may only feed
    # the prefix sum over the small per-block count table.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert any("sum(__n" in x for x in lines[max(0, i - 3):i]), lines[i - 3:i]
    assert "hashpartitioning(__rblock" in plan


def test_asof_keeps_null_reading(spark):
    hist = spark.createDataFrame([(0, T0, 1.0), (0, T0 + timedelta(hours=10), None)],
                                 "station long, time timestamp_ntz, pm2_5 double")
    fut = spark.createDataFrame([(0, T0 + timedelta(hours=15))], "station long, time timestamp_ntz")
    r = FC.forecast_features(hist, fut, pollutants=["pm2_5"], lags=[1], widths=[6], include_calendar=False).collect()
    assert r[0]["pm2_5_lag_1h"] is None


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = stats.histogram(df, "x", [5]).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 0, 0, 1]


def test_r2_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "pm2_5 double, pred_pm2_5 double")
    assert E.metrics(df, ["pm2_5"]).collect()[0]["r2"] == 1.0
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "pm2_5 double, pred_pm2_5 double")
    assert E.metrics(df, ["pm2_5"]).collect()[0]["r2"] == 0.0


def test_chrono_split_order(spark):
    df = _series(spark, [float(i) for i in range(10)])
    s = E.chrono_split(df).toPandas()
    assert s.is_test.sum() == 2
    assert s[~s.is_test].time.max() < s[s.is_test].time.min()


def test_describe_matches_pandas(spark):
    vals = [1.0, 2.0, 4.0, 8.0, 16.0, None]
    df = _series(spark, vals)
    d = stats.describe(df, ["pm2_5"]).collect()[0]
    p = pd.Series(vals).describe()
    assert d["count"] == p["count"] and np.isclose(d["std"], p["std"]) and np.isclose(d["p25"], p["25%"])
    assert np.isclose(d["p75"], p["75%"]) and np.isclose(d["p50"], p["50%"])


def test_corr_constant_is_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, b double")
    r = stats.corr_matrix(df, ["a", "b"]).where((F.col("a") == "a") & (F.col("b") == "b")).collect()[0]["r"]
    assert r != r  # NaN


def _forecast_events(spark, tmp_dir, undated):
    """Events of seven days; station 1 starts 40 hours before the forecast time, has no ``error`` but in the last six of them, and events without a time."""
    import random

    rng, rows, kinds = random.Random(4), [], list(fx.TYPE_TO_POLLUTANT)
    end = T0 + timedelta(days=4)
    for s in (0, 1, 2, None):
        for h in range(24 * 7):
            t = T0 + timedelta(hours=h)
            if s == 1 and t < end - timedelta(hours=40) or rng.random() < 0.1:
                continue
            some = [k for k in kinds if rng.random() < 0.7 and not (s == 1 and k == "error" and t < end - timedelta(hours=6))]
            rows += [(t + timedelta(minutes=rng.randrange(60)), s, k, rng.randrange(5000) / 100, f'{{"k": {rng.randrange(90)}}}') for k in some]
    rows += [(None, 1, k, 3.0, '{"k": 5}') for k in kinds] * undated
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.write.parquet(f"{tmp_dir}/events.parquet")
    return tmp_dir


@pytest.mark.parametrize("undated", [0, 1])
def test_forecast_inputs_of_the_table_of_all_hours(spark, tmp_dir, undated):
    d = _forecast_events(spark, tmp_dir, undated)
    air, weather = fx.landed(spark, d)
    table = features.build_features(air, weather, strategy="auto")
    history, future = QF.inputs_of(table, air, weather, fx.as_of(spark, d))
    want_history, want_future = QF.inputs(spark, d)
    sorted_rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    got = sorted_rows(history.select("station", "time", *POLLUTANTS))
    assert got == sorted_rows(want_history.select("station", "time", *POLLUTANTS)) and {r[0] for r in got} == {0, 2}
    assert sorted_rows(future) == sorted_rows(want_future) and len(sorted_rows(future)) > 100
    assert table.where(F.col("station") == 1).where(F.col("time") < fx.as_of(spark, d)).isEmpty() == (not undated)


def test_forecast_builds_its_features_once(spark, tmp_dir, monkeypatch):
    from aerolith.plans import queries

    d, calls, build = _forecast_events(spark, tmp_dir, 0), [], features.build_features
    monkeypatch.setattr(features, "build_features", lambda *a, **b: calls.append(a) or build(*a, **b))
    out = queries()["forecast"](spark, d)
    assert len(calls) == 1 and out.count() == QF.inputs(spark, d)[1].count()
