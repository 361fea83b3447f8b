"""Rank blocks of bounded rows (R1-R3), radix selection (exact quantiles) and the global chronological split."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators import evaluation as E
from aerolith.operators import scale, select, stats, windows

HOT = 200_000


@pytest.fixture(scope="module")
def hot(spark):
    """One key with 200,000 readings in two days (with equal times and missing values), some short keys and one without a name."""
    t0 = F.lit("2024-01-01").cast("timestamp_ntz")
    value = F.when(F.rand(3) < 0.6, F.floor(F.rand(4) * 1000) / 10)
    one = spark.range(HOT).select(F.lit(1).cast("long").alias("station"), F.timestamp_add("MICROSECOND", F.col("id") * 860_000, t0).alias("time"), "id", value.alias("pm2_5"))
    few = spark.range(300).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4 + 1).alias("station"), F.timestamp_add("HOUR", F.floor(F.col("id") / 8), t0).alias("time"), "id", value.alias("pm2_5"))
    return select.materialised(one.unionByName(few).orderBy(F.rand(5)), "hot").cache()


def test_ranks_of_a_hot_key_spread_over_the_partitions(spark, hot):
    ranked = scale.with_series_rank(hot, ["station"], tiebreak=["id"])
    plain = hot.withColumn("r", F.expr("row_number() OVER (PARTITION BY station ORDER BY time, id)"))
    both = ranked.join(plain.select(F.col("station").alias("s"), F.col("id").alias("i"), "r"), F.col("station").eqNullSafe(F.col("s")) & (F.col("id") == F.col("i")))
    assert both.count() == hot.count() and both.where("__rank <> r").isEmpty()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = spark.read.parquet(*ranked.inputFiles()).groupBy("__part").count().toPandas()["count"]
    assert len(placed) == parts and placed.max() < 2 * HOT / parts


def test_blocked_windows_equal_plain_ones_on_a_hot_key(hot):
    a = windows.lag_and_rolling(hot, ["pm2_5"], keys=["station"], tiebreak=["id"], strategy="plain")
    b = windows.lag_and_rolling(hot, ["pm2_5"], keys=["station"], tiebreak=["id"], strategy="auto")
    assert "__rblock" in b._jdf.queryExecution().toString() and scale.longest_series(hot, ["station"]) == HOT
    rounded = lambda df: df.select("station", "id", *[F.round(c, 6).alias(c) for c in df.columns if c not in ("station", "id", "time")])
    assert rounded(a).exceptAll(rounded(b)).isEmpty() and b.count() == hot.count()
    part = "PARTITION BY `station`, `__rblock`"
    own = windows.lag_features(hot, ["pm2_5"], [1], keys=["station"], tiebreak=["id"], strategy="blocked", block_rows=5000)
    assert part.replace("`", "")[:12] and own.count() == hot.count()


def test_blocked_fill_equals_plain_fill(hot):
    sparse = hot.withColumn("pm2_5", F.when(F.col("id") % 9001 == 5, F.col("pm2_5")))  # longer gaps than a block
    a = windows.ffill(sparse, ["pm2_5"], keys=["station"], tiebreak=["id"], strategy="plain")
    b = windows.ffill(sparse, ["pm2_5"], keys=["station"], tiebreak=["id"], strategy="blocked", block_rows=1000)
    assert a.exceptAll(b).isEmpty() and b.count() == hot.count() and b.where("pm2_5 is null").count() == a.where("pm2_5 is null").count()


def test_series_without_keys(spark, hot):
    some = hot.where("station = 1 and id < 3000")
    a = windows.lag_and_rolling(some.withColumn("one", F.lit(1)), ["pm2_5"], keys=["one"], tiebreak=["id"], strategy="plain").drop("one")
    b = windows.lag_and_rolling(some, ["pm2_5"], keys=[], tiebreak=["id"], strategy="auto", block_rows=256)
    assert a.select(b.columns).exceptAll(b).isEmpty() and b.count() == 3000


def doubles(rng, n):
    out = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1.0,
           math.nextafter(1, 2), math.nextafter(1, 0), 2.0, math.nextafter(2, 0), 0.1, -0.1, 1e300, 3.0, 1 / 3]
    return out + [math.ldexp(rng.uniform(-1, 1), rng.randint(-1074, 1023)) for _ in range(n)]


def test_keys_sort_as_doubles_and_go_back(spark):
    xs = doubles(random.Random(1), 3000)
    rows = spark.createDataFrame([(x,) for x in [*xs, None, float("nan")]], "x double")
    rows = select.with_double_key(rows, "x", "k")
    rows = rows.withColumn("back", select.key_double(F.col("k"))).collect()
    assert all(r.k is None for r in rows if r.x is None or math.isnan(r.x)) and sum(r.k is None for r in rows) == 2
    rows = [r for r in rows if r.k is not None]
    assert all(r.back == r.x for r in rows)
    want = np.array([r.x for r in rows]).view(np.int64)
    assert all(r.k == (w if r.x > 0 else -(int(w) & (2**63 - 1)) if r.x < 0 else 0) for r, w in zip(rows, want.tolist(), strict=True))


def test_quantiles_of_a_million_distinct_values_in_one_group(spark):
    rows = spark.range(1_000_000).select(F.lit("a").alias("g"), (F.sin(F.col("id").cast("double")) * F.exp(F.col("id") % 23)).alias("x"))
    rows = rows.unionByName(spark.createDataFrame([("b", 2.0), ("b", None), ("b", float("nan")), ("c", None), (None, 1.0), (None, 4.0), ("d", -1e308), ("d", 1e308)], "g string, x double"))
    rows = select.materialised(rows, "million")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in select.quantiles(rows, probs, ["g"]).collect()}
    a = np.sort(rows.where("g = 'a'").toPandas()["x"].to_numpy())
    assert got["a"].n == len(a) and np.allclose([got["a"][f"q{i}"] for i in range(5)], np.quantile(a, probs), rtol=1e-12, atol=0)
    assert [got["b"][f"q{i}"] for i in range(5)] == [2.0] * 5 and "c" not in got
    assert got[None].n == 2 and got[None].q2 == 2.5 and got["d"].q0 == -1e308 and got["d"].q4 == 1e308
    plan = select.quantiles(rows, probs, ["g"])._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_describe_and_boxes_use_no_value_map(spark):
    df = spark.createDataFrame([(i % 2, float(i), None if i % 3 else float(-i)) for i in range(50)] + [(0, None, None)], "k long, a double, b double")
    d = stats.describe(df, ["a", "b"], ["k"])
    assert "percentile" not in d._jdf.queryExecution().toString()
    pdf = df.toPandas()
    got = {(r.k, r.column): r for r in d.collect()}
    for k in (0, 1):
        want = pdf[pdf.k == k][["a", "b"]].describe()
        for c in "ab":
            r = got[k, c]
            assert np.allclose([r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]], want[c].to_numpy())
    assert stats.describe(df.where("false"), ["a"]).collect()[0]["count"] == 0
    assert "percentile" not in stats.box_stats(df, "a", ["k"])._jdf.queryExecution().toString()


@pytest.mark.parametrize("ratio", [0.2, 0.5, 0.12345, 1 - 0.87655, 0.0, 1.0])
def test_global_split_is_exact_and_has_no_single_task(spark, hot, ratio):
    n = hot.count()
    out = E.chrono_split(hot, [], tiebreak=["station", "id"], test_ratio=ratio)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    cut = int(n * (1 - ratio))
    assert out.where("not is_test").count() == cut
    if 0 < cut < n:
        edge = F.struct("time", "station", "id")
        assert out.where("not is_test").agg(F.max(edge)).first()[0] < out.where("is_test").agg(F.min(edge)).first()[0]


def test_split_by_selection_equals_the_window(spark, hot):
    a = E.chrono_split(hot, ["station"], tiebreak=["id"])
    b = E.chrono_split(hot, ["station"], tiebreak=["id"], strategy="select")
    assert a.exceptAll(b).isEmpty() and b.count() == hot.count()
    assert E.chrono_split(hot.where("false"), []).count() == 0
