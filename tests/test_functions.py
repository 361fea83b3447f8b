"""Hand-computed cases of the index, calendar and name functions (FIXTURES.md §4)."""

from datetime import datetime

from pyspark.sql import functions as F

from aerolith.functions import aqi as A
from aerolith.functions.calendar import add_calendar
from aerolith.sources.files import chunk_table, normalise_names, rename_clean


def _col(spark, values, name="x", t="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {t}")


def test_pm25_subindex_reference_mode(spark):
    df = _col(spark, [12.0, 12.05, 12.1, 35.45, -3.0, 600.0, None])
    got = [r[0] for r in df.select(A.pollutant_subindex("pm2_5", "x")).collect()]
    assert got == [50, 177, 51, 193, 168, 566, None]


def test_subindex_epa_mode(spark):
    df = _col(spark, [12.05, -3.0, 35.45])
    got = [r[0] for r in df.select(A.pollutant_subindex("pm2_5", "x", mode="epa")).collect()]
    assert got == [50, None, 100]


def test_forecast_index(spark):
    df = _col(spark, [12.05, -1.0, 500.5, None, 12.0])
    got = [r[0] for r in df.select(A.pm25_forecast_index("x")).collect()]
    assert got == [500, 500, 500, 500, 50]


def test_half_even_rounding(spark):
    df = _col(spark, [0.5, 1.5, 2.5, -49.5])
    got = [r[0] for r in df.select(F.bround("x", 0).cast("bigint")).collect()]
    assert got == [0, 2, 2, -50]


def test_status_levels(spark):
    df = _col(spark, [50.0, 50.5, 100.0, 150.0, 151.0])
    got = [r[0] for r in df.select(A.status("x")).collect()]
    assert got == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy"]


def test_overall_null_and_max(spark):
    df = spark.createDataFrame([(12.0, 54.0, 10.0, 10.0, 100.0), (None, 54.0, 10.0, 10.0, 100.0)],
                               "pm2_5 double, pm10 double, nitrogen_dioxide double, sulphur_dioxide double, "
                               "carbon_monoxide double")
    got = [r[0] for r in df.select(A.overall_aqi()).collect()]
    assert got == [50, None]


def test_weekday_and_weekend(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 6),)], "time timestamp_ntz")
    rows = add_calendar(df).select("day_of_week", "is_weekend").collect()
    assert [(r[0], r[1]) for r in rows] == [(0, 0), (5, 1)]


def test_name_cleaning(spark):
    assert normalise_names(["PM2_5 (μg/m³)"]).clean["PM2_5 (μg/m³)"] == "pm2_5"
    assert normalise_names(["Wind Speed-10m (km/h)"]).clean["Wind Speed-10m (km/h)"] == "wind_speed_10m"
    df = spark.createDataFrame([(1.0, 2.0)], "`A (x)` double, `a` double")
    try:
        rename_clean(df)
        raise AssertionError("collision not detected")
    except ValueError:
        pass


def test_chunks(spark):
    r = spark.createDataFrame([(datetime(2023, 1, 1).date(), datetime(2024, 5, 20).date())],
                              "start_date date, end_date date")
    rows = chunk_table(r, 60).orderBy("chunk").collect()
    last2 = [(str(x.chunk_start), str(x.chunk_end)) for x in rows[-2:]]
    assert last2 == [("2024-03-03", "2024-05-02"), ("2024-05-03", "2024-05-20")]


def test_epa_mode_at_every_band_edge(spark):
    """Both ends of every band of all five pollutants, one step inside and one step beyond."""
    for pol, bands in A.BANDS.items():
        step = A.EPA_PRECISION[pol]
        rows = [(round(x, 1), i) for lo, hi, ilo, ihi in bands for x, i in ((lo, ilo), (hi, ihi))]
        rows += [(round(hi + step / 2, 2), ihi) for _, hi, _, ihi in bands[:-1]]  # truncated back to the edge
        df = spark.createDataFrame([(float(x), i) for x, i in rows], "c double, want long")
        got = df.select("c", "want", A.subindex("c", bands, mode="epa", precision=step).alias("got")).collect()
        assert [(r.c, r.got) for r in got] == [(r.c, r.want) for r in got], pol
    odd = spark.createDataFrame([(-0.1,), (None,)], "c double").select(A.subindex("c", A.BANDS["pm2_5"], mode="epa", precision=0.1).alias("i"))
    assert [r.i for r in odd.collect()] == [None, None]


def test_payload_explode_of_empty_and_unequal_payloads(spark):
    from aerolith.sources.files import payload_explode

    df = spark.createDataFrame([(1, 0, 0, 3600, [1.0], [2.0]), (2, 3600, 0, 3600, [1.0], []), (3, 0, 7200, 3600, [1.0], [float("nan"), 4.0]),
                                (4, 0, 3600, 3600, None, [])],
                               "station long, start long, end long, interval long, a array<double>, b array<double>")
    got = payload_explode(df, ["a", "b"]).orderBy("station", "time").collect()
    assert [(r.station, r.time.hour, r.a, r.b) for r in got] == [(3, 0, 1.0, None), (3, 1, None, 4.0), (4, 0, None, None)]


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest

    from aerolith.config import checkpoint_dir

    class Nothing:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "local-cluster[2,1,1024]"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Nothing)


def test_names_report_collisions_and_bad_names():
    got = normalise_names(["A b (x)", "a-b (y)", "2m (°C)", "ok"])
    assert got.collisions == {"a_b": ["A b (x)", "a-b (y)"]} and got.invalid == ["2m"]


def test_column_or(spark):
    from aerolith.operators.clean import column_or

    df = spark.createDataFrame([(1.0, None), (2.0, 5.0)], "a double, b double")
    rows = df.select(column_or(df, "b").alias("own"), column_or(df, "c", other="a").alias("other"), column_or(df, "c", "d", 7.0).alias("default"),
                     column_or(df, "c", "d").alias("none")).collect()
    assert [tuple(r) for r in rows] == [(None, 1.0, 7.0, None), (5.0, 2.0, 7.0, None)]
