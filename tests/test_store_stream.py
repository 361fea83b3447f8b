"""Store upsert, high-water mark, stream = batch (T1-T3), and the driver contract."""

import os
import uuid

from pyspark.sql import functions as F

from aerolith.config import scratch_path
from aerolith.operators import features
from aerolith.sources import fixtures as fx
from aerolith.sources import store
from aerolith.streaming import incremental as I

from .conftest import SF_SMALL


def test_upsert_idempotent_last_write_wins(spark):
    f = features.build_features(fx.air(spark, SF_SMALL), fx.weather(spark, SF_SMALL)).select(
        "station", "time", "pm2_5")
    path = scratch_path(spark, "t-upsert")
    store.upsert(spark, f.withColumn("v", F.lit(1)), path, ["station", "time"])
    half = f.where(F.col("time") >= F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("v", F.lit(2))
    store.upsert(spark, half, path, ["station", "time"])
    once = store.read(spark, path).select("station", "time", "pm2_5", "v").collect()
    store.upsert(spark, half, path, ["station", "time"])
    twice = store.read(spark, path).select("station", "time", "pm2_5", "v").collect()
    assert sorted(once) == sorted(twice)
    assert len(once) == f.count()
    assert {r.v for r in once if str(r.time) >= "2024-01-15"} == {2}


def test_incremental_rows_high_water(spark):
    df = spark.createDataFrame([(0, "2024-01-01 01:00:00"), (0, "2024-01-01 03:00:00")], "station long, t string") \
        .select("station", F.col("t").cast("timestamp_ntz").alias("time"))
    old = df.where(F.col("time") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    assert store.incremental_rows(df, old).count() == 1
    assert store.incremental_rows(df, None).count() == 2


def _hourly(batch):
    b = batch.select((F.col("user_id") % 5).alias("station"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), "value")
    return b.groupBy("station", "time").agg(F.avg("value").alias("pm2_5"), F.max("value").alias("pm10"), F.min("value").alias("nitrogen_dioxide"),
                                           F.count("value").cast("double").alias("sulphur_dioxide"), F.sum("value").alias("carbon_monoxide"))


def _rows(df, cols):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(cols).collect())


def _land(spark, root, parts):
    """One file for each batch, in the order of their modification times."""
    import time

    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{root}/src")
        time.sleep(1.1 if i < len(parts) - 1 else 0)


def test_stream_equals_batch(spark):
    """One stream of three batches cut in the middle of hours, with late and repeated rows, gives the batch's features."""
    root = scratch_path(spark, "t-stream")
    ts = lambda x: F.lit(x).cast("timestamp_ntz")
    ev = fx.table(spark, SF_SMALL, "events").where(F.col("ts") < ts("2024-01-10"))
    late = (F.col("event_id") % 7 == 0) & (F.col("ts") >= ts("2024-01-02")) & (F.col("ts") < ts("2024-01-04 03:30:00"))
    one = ev.where((F.col("ts") < ts("2024-01-04 03:30:00")) & ~late)
    two = ev.where((F.col("ts") >= ts("2024-01-04 03:30:00")) & (F.col("ts") < ts("2024-01-07 15:20:00"))).unionByName(one.where("event_id % 11 = 0"))
    three = ev.where(F.col("ts") >= ts("2024-01-07 15:20:00")).unionByName(ev.where(late))
    _land(spark, root, [one, two, three])
    q = I.run_incremental(spark, f"{root}/src", fx.EVENTS_SCHEMA, f"{root}/table", f"{root}/ckpt", _hourly,
                          key_columns={"station": F.col("user_id") % 5}, files_per_batch=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    batch = I.hourly_features(_hourly(ev))
    cols = sorted(batch.columns)
    streamed = store.read(spark, f"{root}/table/features")
    assert _rows(streamed, cols) == _rows(batch, cols)


def test_strict_stream_drops_late_rows_by_key_and_counts_them(spark):
    root = scratch_path(spark, "t-strict")
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    rows = lambda *r: spark.createDataFrame([(i, u, f"2024-01-01 {t}:00", v) for i, u, t, v in r], "event_id long, user_id long, t string, value double") \
        .select("event_id", "user_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    _land(spark, root, [rows((1, 0, "05:10", 2.0), (2, 1, "01:10", 1.0)),
                        rows((3, 0, "05:50", 10.0), (4, 0, "03:00", 7.0), (5, 1, "02:00", 4.0))])
    dropped = []
    I.run_incremental(spark, f"{root}/src", spark.createDataFrame([], schema).schema, f"{root}/table", f"{root}/ckpt", _hourly, strict=True,
                      key_columns={"station": F.col("user_id") % 5}, files_per_batch=1, dropped=dropped).awaitTermination()
    got = {(r.station, r.time.hour): r.carbon_monoxide for r in store.read(spark, f"{root}/table/features").collect()}
    assert got == {(0, 5): 12.0, (1, 1): 1.0, (1, 2): 4.0}  # the split hour is whole, the slower station keeps its rows
    assert dropped == [1]


def test_store_reads_only_the_dates_it_needs(spark):
    path = scratch_path(spark, "t-prune")
    df = spark.range(240).select((F.col("id") % 3).alias("station"), F.timestamp_add("HOUR", "id", F.lit("2024-01-01").cast("timestamp_ntz")).alias("time"), F.lit(1.0).alias("v"))
    store.upsert(spark, df.unionByName(df), path, ["station", "time"])
    table = store.read(spark, path)
    assert table.count() == 240  # the first batch is one row per key, too
    days = store.days_of(table)
    for part in (store.on_days(table, days[-2:]), store.since(table, days[-2])):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and part.count() == 48


def test_driver_contract(spark):
    import importlib.util

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location(f"entry_{uuid.uuid4().hex}", f"{here}/__spark_entry__.py")
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    df = m.entry(spark)
    assert df.count() >= 0 and "pm2_5_lag_24h" in df.columns
    qs, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 50


def test_stream_join_and_alerts_equal_batch(spark):
    """T4 stream-stream join on (station, hour) and T6 alert filter equal their batch results."""
    from aerolith.functions import aqi as A

    root = scratch_path(spark, "t-join")
    a = fx.air(spark, SF_SMALL).select("station", "time", "pm2_5", "pm10")
    w = fx.weather(spark, SF_SMALL).select("station", "time", "temperature_2m")
    a.write.parquet(f"{root}/air")
    w.write.parquet(f"{root}/weather")
    sa = spark.readStream.schema(a.schema).parquet(f"{root}/air")
    sw = spark.readStream.schema(w.schema).parquet(f"{root}/weather")
    joined = I.join_streams(sa, sw, delay="3 hours")
    scored = joined.withColumn("us_epa_aqi", A.pm25_forecast_index("pm2_5"))
    name = f"alerts_{uuid.uuid4().hex[:8]}"
    q = (I.alert_stream(scored).writeStream.format("memory").queryName(name).outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", f"{root}/ckpt").start())
    q.awaitTermination()
    got = sorted(spark.table(name).select("station", "time").collect())
    batch = a.join(w, ["station", "time"]).withColumn("us_epa_aqi", A.pm25_forecast_index("pm2_5"))
    want = sorted(I.alert_stream(batch).select("station", "time").collect())
    assert got == want and len(want) > 0


# ---------------------------------------------------------------- versions, statistics, corrections


def _keyed(spark, rows):
    return spark.createDataFrame([(k, f"2024-01-{d:02d} {h:02d}:00:00", v) for k, d, h, v in rows], "k long, t string, v double").select(
        "k", F.col("t").cast("timestamp_ntz").alias("time"), "v")


def _content(df):
    return sorted((r.k, r.time.day, r.time.hour, r.v) for r in df.collect())


def test_a_reader_keeps_its_version_and_a_stale_writer_changes_nothing(spark):
    import pytest

    path = scratch_path(spark, "t-version")
    assert store.read(spark, path) is None and store.high_water(spark, path) is None
    store.merge(spark, _keyed(spark, [(1, 1, 0, 1.0), (2, 2, 0, 2.0)]), path, ["k"])
    first = store.current(spark, path)
    reader = store.read(spark, path)
    store.merge(spark, _keyed(spark, [(1, 1, 5, 9.0), (3, 3, 0, 3.0)]), path, ["k"])
    assert _content(reader) == [(1, 1, 0, 1.0), (2, 2, 0, 2.0)]  # opened before the switch
    assert _content(store.read(spark, path)) == [(1, 1, 5, 9.0), (2, 2, 0, 2.0), (3, 3, 0, 3.0)]
    assert _content(store.read(spark, path, first)) == _content(reader)
    with pytest.raises(store.StaleVersion):
        store.merge(spark, _keyed(spark, [(4, 4, 0, 4.0)]), path, ["k"], base=first)
    assert len(_content(store.read(spark, path))) == 3

    # A write that fails before its commit changes nothing, nor does one whose commit was not yet pointed to stay unseen.
    broken = _keyed(spark, [(5, 5, 0, 5.0)]).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.merge(spark, broken, path, ["k"])
    assert store.current(spark, path).number == 2
    store._replace_text(spark, f"{path}/_current", "1")  # as if the writer was lost between version file and pointer
    assert store.current(spark, path).number == 2 and len(_content(store.read(spark, path))) == 3
    store.merge(spark, _keyed(spark, [(6, 6, 0, 6.0)]), path, ["k"])
    assert store.current(spark, path).number == 3
    gone = store.vacuum(spark, path, keep=1)
    assert len(gone) == 0 or len(_content(store.read(spark, path))) == 4
    assert len(_content(store.read(spark, path))) == 4


def test_a_key_that_moves_to_another_day_leaves_the_old_one_and_deletes_work(spark):
    path = scratch_path(spark, "t-move")
    store.merge(spark, _keyed(spark, [(1, 1, 23, 1.0), (2, 1, 22, 2.0), (None, 2, 1, 3.0)]), path, ["k"])
    change = store.merge(spark, _keyed(spark, [(1, 2, 0, 1.5), (None, 5, 1, 4.0)]), path, ["k"])
    assert sorted((r.k or 0, r.v) for r in change.old.collect()) == [(0, 3.0), (1, 1.0)]
    assert sorted((r.k or 0, r.time.day, r.v) for r in store.read(spark, path).collect()) == [(0, 5, 4.0), (1, 2, 1.5), (2, 1, 2.0)]
    store.merge(spark, _keyed(spark, []), path, ["k"], deletes=spark.createDataFrame([(2,), (77,)], "k long"))
    assert sorted((r.k or 0) for r in store.read(spark, path).collect()) == [0, 1]
    assert "2024-01-01" not in store.current(spark, path).parts  # an empty day is no day of the table
    timed = scratch_path(spark, "t-timed")
    store.merge(spark, _keyed(spark, [(1, 1, 23, 1.0), (1, 2, 0, 2.0)]), timed, ["k", "time"])
    store.merge(spark, _keyed(spark, []), timed, ["k", "time"], deletes=_keyed(spark, [(1, 2, 0, 0.0)]).select("k", "time"))
    assert _content(store.read(spark, timed)) == [(1, 1, 23, 1.0)]


def test_high_water_reads_the_statistics_only(spark):
    path = scratch_path(spark, "t-marks")
    df = spark.range(24 * 20).select((F.col("id") % 3).alias("station"), F.timestamp_add("HOUR", "id", F.lit("2024-01-01").cast("timestamp_ntz")).alias("time"), F.lit(1.0).alias("v"))
    store.merge(spark, df, path, ["station", "time"])
    store.merge(spark, df.where("station = 2").withColumn("time", F.col("time") + F.expr("INTERVAL 30 DAYS")).where("id IS NOT NULL" if "id" in df.columns else "true"), path, ["station", "time"])
    table = store.read(spark, path)
    for keys in ([], ["station"]):
        marks = store.high_water(spark, path, keys)
        files = marks.inputFiles()
        assert files and all("/stats/" in f for f in files)
        assert sorted(map(tuple, marks.collect())) == sorted(map(tuple, store.max_time(table, "time", keys).collect()))
        assert len({f.rpartition("date=")[2][:10] for f in files}) == (1 if not keys else len(store.current(spark, path).parts))
        new = df.withColumn("time", F.col("time") + F.expr("INTERVAL 5 DAYS"))
        assert sorted(store.rows_after(new, marks, keys=keys).collect()) == sorted(store.incremental_rows(new, table, keys=keys).collect())
    stats = store.statistics(spark, path)
    assert stats.agg(F.sum("n")).first()[0] == table.count()


_EVENT = "event_id long, user_id long, ts timestamp_ntz, value double"


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, t string, value double").select(
        "event_id", "user_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value")


def _stream(spark, root, parts, **how):
    _land(spark, root, parts)
    schema = spark.createDataFrame([], _EVENT).schema
    q = I.run_incremental(spark, f"{root}/src", schema, f"{root}/table", f"{root}/ckpt", _hourly, key_columns={"station": F.col("user_id") % 5}, files_per_batch=1, **how)
    q.awaitTermination()


def test_corrected_times_reach_every_hour_and_feature(spark):
    """A time corrected within a day, one across midnight, a value, a key; hours left without events go with their features."""
    root = scratch_path(spark, "t-correct")
    first = [(i, i % 2, f"2024-01-0{1 + i // 24} {i % 24:02d}:10:00", float(i)) for i in range(60)] + [(100, 0, "2024-01-01 05:30:00", 7.0)]
    fixes = [(5, 1, "2024-01-01 06:20:00", 5.0), (23, 1, "2024-01-02 00:20:00", 23.0), (30, 0, "2024-01-02 06:10:00", 99.0), (41, 0, "2024-01-02 17:10:00", 41.0), (100, 0, "2024-01-03 01:00:00", 8.0)]
    _stream(spark, root, [_events(spark, first), _events(spark, fixes)])
    final = {r[0]: r for r in first} | {r[0]: r for r in fixes}
    batch = I.hourly_features(_hourly(_events(spark, list(final.values()))))
    cols = sorted(batch.columns)
    for name, want in (("hourly", _hourly(_events(spark, list(final.values())))), ("features", batch)):
        got = store.read(spark, f"{root}/table/{name}")
        names = [c for c in cols if c in want.columns]
        assert _rows(got, names) == _rows(want, names)
    assert store.read(spark, f"{root}/table/raw").count() == len(final)


def test_a_batch_that_failed_half_way_repairs_the_same_hours(spark, monkeypatch):
    """The first try dies after the raw merge: the second must still delete the old hour of the corrected event."""
    root = scratch_path(spark, "t-retry")
    first = [(i, 0, f"2024-01-01 {i:02d}:10:00", float(i)) for i in range(10)]
    _stream(spark, root, [_events(spark, first)])
    _events(spark, [(3, 0, "2024-01-02 03:00:00", 33.0)]).coalesce(1).write.mode("append").parquet(f"{root}/src")
    schema = spark.createDataFrame([], _EVENT).schema
    run = lambda hourly: I.run_incremental(spark, f"{root}/src", schema, f"{root}/table", f"{root}/ckpt", hourly, key_columns={"station": F.col("user_id") % 5}).awaitTermination()

    def dies(batch):
        raise RuntimeError("lost")

    import pytest

    with pytest.raises(Exception, match="lost"):
        run(dies)
    assert store.read(spark, f"{root}/table/raw").where("event_id = 3").first().value == 33.0
    run(_hourly)
    hours = {(r.time.day, r.time.hour) for r in store.read(spark, f"{root}/table/features").collect()}
    assert hours == {(1, h) for h in range(10) if h != 3} | {(2, 3)}


def test_watermarked_rollup_counts_late_and_repeated_events(spark):
    root = scratch_path(spark, "t-rollup")
    day = lambda rows: _events(spark, [(i, u, f"2024-01-01 {t}:00", v) for i, u, t, v in rows])
    one = day([(1, 0, "01:10", 1.0), (2, 0, "01:50", 2.0), (2, 0, "01:50", 2.0), (3, 1, "02:10", 3.0)])
    two = day([(4, 0, "01:20", 4.0), (1, 0, "01:10", 1.0), (5, 0, "09:00", 5.0)])  # in time, repeated, and the watermark goes to 07:00
    more = day([(9, 0, "09:10", 9.0)])  # rows are held against the watermark of the trigger before
    three = day([(6, 0, "02:30", 6.0), (7, 1, "08:30", 7.0)])  # too late, in time
    four = day([(8, 0, "23:00", 8.0)])
    _land(spark, root, [one, two, more, three, four])
    schema = spark.createDataFrame([], _EVENT).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/src")
    out = I.rollup_stream(stream, ["user_id"], "ts", {"n": F.count(F.lit(1)), "total": F.sum("value")}, "2 hours", ["event_id"])
    q = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.user_id, r.window_start.hour): (r.n, r.total) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(0, 1): (3, 7.0), (1, 2): (1, 3.0), (0, 9): (2, 14.0), (1, 8): (1, 7.0)}
    assert I.rollup_counts(q) == {"events": 11, "distinct": 8, "late": 1}
