"""Structured Streaming form of the hourly jobs.

The reference runs a scheduled micro-batch: every hour it refetches the last days,
rebuilds lags with context, and inserts only rows newer than the stored maximum.
Here that is a file stream with ``trigger(availableNow=True)`` and a checkpoint:

* ``hourly_rollup`` (T5): tumbling one-hour windows per key; ``rollup_stream`` runs it on a stream in append mode behind
  a watermark, repeated events dropped within it, with the events counted by ``observe`` (``rollup_counts`` reads them).
* ``run_incremental`` (T1, T2, T3): ``foreachBatch`` merges the raw rows into a date-partitioned table by event
  (last write wins), aggregates the hours of the touched dates anew from it, so an hour split over batches is whole, and
  recomputes the features of the touched keys from their first touched hour on, with the rows before it as context.
  The merge says which rows it replaced: an event whose time, key or value is corrected touches its old hour and its new one, also
  across midnight, and an hour that no event is left in is deleted with its features.  With ``strict`` raw rows of
  hours before the newest stored hour of their key are dropped instead, counted by ``observe``.  High-water marks come from the
  store's statistics, and reads are pruned to the dates they need.  A micro-batch that runs again after a
  failure reuses the list of touched hours it wrote before its first merge, so it repairs the same hours.
* ``join_streams`` (T4): stream-stream inner join on key and hour, both watermarked.
* ``alert_stream`` (T6): stateless filter of scored rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolith.config import LAG_HOURS, POLLUTANTS, ROLL_HOURS, scratch_path
from aerolith.functions import aqi as A
from aerolith.functions.calendar import add_calendar
from aerolith.operators.forecast import history_tail
from aerolith.operators.windows import lag_and_rolling
from aerolith.sources import store


def hourly_rollup(df: DataFrame, keys: Sequence[str], time_col: str, aggs: dict) -> DataFrame:
    """T5: per key and tumbling hour: ``aggs`` (name -> aggregate Column), window start/end."""
    g = df.groupBy(*keys, F.window(F.col(time_col), "1 hour").alias("__w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    return g.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                    *aggs.keys())


def rollup_stream(stream: DataFrame, keys: Sequence[str], time_col: str, aggs: dict, delay: str, event_keys: Sequence[str],
                  metrics: str = "rollup") -> DataFrame:
    """T3 + T5 end to end: repeated events dropped within the watermark, then closed hours in append mode.

    Events later than ``delay`` are dropped by the aggregate; each trigger reports, under ``metrics``, ``events`` (that arrived) and
    ``distinct_events`` (after the removal of repeated ones).  ``aggs`` should count its events, so that late ones can be told.
    """
    arrived = stream.observe(f"{metrics}_events", F.count(F.lit(1)).alias("n"))
    distinct = with_lateness(arrived, event_keys, time_col, delay, with_time=False)
    return hourly_rollup(distinct.observe(f"{metrics}_distinct", F.count(F.lit(1)).alias("n")), keys, time_col, aggs)


def rollup_counts(query: StreamingQuery, metrics: str = "rollup") -> dict[str, int]:
    """Of a ``rollup_stream`` query so far: events, repeated (dropped as such or too late to be told), late (dropped behind the watermark by any operator)."""
    out = {"events": 0, "distinct": 0, "late": 0}
    for p in query.recentProgress:
        seen = p.observedMetrics
        for name, key in ((f"{metrics}_events", "events"), (f"{metrics}_distinct", "distinct")):
            if name in seen:
                out[key] += seen[name]["n"]
        out["late"] += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
    return out


def _event_time(df: DataFrame, time_col: str) -> DataFrame:
    """Watermarks need a TIMESTAMP event time; hourly tables carry timestamp_ntz (UTC wall
    clock).  Cast for the stateful operator (session zone UTC, see ``get_session``)."""
    if df.schema[time_col].dataType.typeName() == "timestamp_ntz":
        return df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return df


def with_lateness(df: DataFrame, keys: Sequence[str], time_col: str, delay: str, with_time: bool = True) -> DataFrame:
    """T3 lateness option: accept rows up to ``delay`` late, drop duplicates of (keys, time), or of keys alone, within it."""
    df = _event_time(df, time_col).withWatermark(time_col, delay)
    return df.dropDuplicatesWithinWatermark([*keys, time_col] if with_time else list(keys))


def join_streams(air: DataFrame, weather: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                 delay: str = "2 hours") -> DataFrame:
    """T4: inner join of two watermarked streams on (keys, time); state is bounded by the watermark."""
    ntz = air.schema[time_col].dataType.typeName() == "timestamp_ntz"
    a = _event_time(air, time_col).withWatermark(time_col, delay)
    w = _event_time(weather, time_col).withWatermark(time_col, delay)
    j = a.join(w, [*keys, time_col], "inner")
    return j.withColumn(time_col, F.col(time_col).cast("timestamp_ntz")) if ntz else j


def alert_stream(scored: DataFrame, aqi_col: str = "us_epa_aqi", threshold: float = A.ALERT_THRESHOLD) -> DataFrame:
    """Alerts are a stateless filter on the scored stream."""
    return scored.where(A.is_alert(aqi_col, threshold))


def hourly_features(hourly: DataFrame, keys: Sequence[str] = ("station",), time_col: str = "time",
                    pollutants: Sequence[str] = POLLUTANTS) -> DataFrame:
    """Calendar, lag and rolling features of hourly rows (T2); whoever calls it adds context rows and drops them again."""
    return lag_and_rolling(add_calendar(hourly, time_col), pollutants, keys=list(keys), time_col=time_col, strategy="plain")


def context_before(hourly: DataFrame, first: DataFrame, first_day, keys: Sequence[str], time_col: str, rows: int) -> DataFrame:
    """The last ``rows`` hours before each key's first touched hour (``first``: keys, __first, __first_day).

    Older dates are read only as far back as some key still lacks rows: the look-back doubles.
    """
    from datetime import date, timedelta

    keys = list(keys)
    oldest = hourly.agg(F.min(store.DATE)).first()[0] or first_day  # only the partition column is read
    back = 2
    while True:
        start = max(oldest, first_day - timedelta(days=back)) if first_day.toordinal() - back > date.min.toordinal() else oldest
        own = store.since(hourly, start).join(first, keys).where(F.col(time_col) < F.col("__first")).drop("__first", "__first_day")
        tail = history_tail(own, rows, keys, time_col)
        if start <= oldest:
            return tail
        short = first.join(tail.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), keys, "left").where(F.coalesce("__n", F.lit(0)) < rows)
        if short.isEmpty():
            return tail
        back *= 2


def run_incremental(spark: SparkSession, source_path: str, schema, table_path: str, checkpoint: str,
                    to_hourly, keys: Sequence[str] = ("station",), time_col: str = "time", strict: bool = False,
                    raw_keys: Sequence[str] = ("event_id",), raw_time: str = "ts", key_columns: dict | None = None,
                    pollutants: Sequence[str] = POLLUTANTS, files_per_batch: int | None = None,
                    dropped: list | None = None) -> StreamingQuery:
    """File stream of raw readings -> hourly rows -> features -> keyed merge, once per trigger.

    ``to_hourly(df)`` turns raw rows into hourly rows with ``keys`` and ``time_col``; ``key_columns`` gives
    each key as a Column over raw rows (default: the column of that name).  Three tables lie under
    ``table_path``: ``raw``, ``hourly`` and ``features``.  ``availableNow`` processes what has landed and stops, the checkpoint
    remembers which files were done.  ``dropped`` takes the number of rows that ``strict`` dropped, a number for each batch.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", str(files_per_batch))
    keys = list(keys)
    raw_key = {k: (key_columns or {}).get(k, F.col(k)) for k in keys}
    hour = F.date_trunc("hour", F.col(raw_time)).cast("timestamp_ntz")
    raw_path, hourly_path, feature_path = (f"{table_path.rstrip('/')}/{n}" for n in ("raw", "hourly", "features"))
    context_rows = max(max(LAG_HOURS), max(ROLL_HOURS))
    hours_of = lambda raw: raw.select(*[c.alias(k) for k, c in raw_key.items()], hour.alias(time_col)).where(F.col(time_col).isNotNull())

    def on_time_rows(batch: DataFrame, batch_id: int) -> DataFrame:
        """``strict``: rows of hours not before the newest stored hour of their key; the others are counted while these are written."""
        marks = store.high_water(spark, hourly_path, keys)
        if marks is None:
            return batch
        marks = marks.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__hw")
        marked = batch.withColumns({f"__key_{k}": c for k, c in raw_key.items()}).join(marks, [f"__key_{k}" for k in keys], "left")
        on_time = F.col("__hw").isNull() | (hour >= F.col("__hw"))
        late = Observation(f"late_{batch_id}_{uuid.uuid4().hex[:8]}")
        kept = marked.observe(late, F.count_if(~on_time).alias("late")).where(on_time).select(*batch.columns)
        observed.append(late)
        return kept

    observed: list = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        observed.clear()
        if strict:
            batch = on_time_rows(batch, batch_id)
        landed = scratch_path(spark, "landed")
        batch.write.parquet(landed)
        if observed and dropped is not None:
            dropped.append(observed[0].get["late"])
        batch = spark.read.schema(batch.schema).parquet(landed)
        if not batch.isEmpty():
            touched = f"{table_path.rstrip('/')}/_touched/batch={batch_id}"
            if not store.exists(spark, f"{touched}/_SUCCESS"):  # else this batch has failed after this point before
                hours, stored = hours_of(batch), store.read(spark, raw_path)
                if stored is not None:
                    hours = hours.unionByName(hours_of(store.matching(stored, batch.select(*raw_keys).distinct())))
                hours.distinct().write.mode("overwrite").parquet(touched)
            affected_hours = spark.read.parquet(touched)
            store.merge(spark, batch, raw_path, raw_keys, raw_time).forget(spark)
            refresh(affected_hours)
            store.delete(spark, touched)
        store.delete(spark, landed)

    def refresh(hours: DataFrame) -> None:
        """Bring the hourly rows and the features up to date after a change of the raw rows of ``hours`` (keys, time)."""
        days = store.days_of(store.with_date(hours, time_col))
        if not days:
            return
        hourly = to_hourly(store.on_days(store.read(spark, raw_path), days).drop(store.DATE))
        cols = hourly.columns
        landed = scratch_path(spark, "hourly")
        hourly.write.parquet(landed)
        hourly = spark.read.schema(hourly.schema).parquet(landed)
        gone = store.matching(hours, hourly.select(*keys, time_col), "left_anti")
        store.merge(spark, hourly, hourly_path, [*keys, time_col], time_col, deletes=gone).forget(spark)
        first = hours.groupBy(*keys).agg(F.min(time_col).alias("__first")).withColumn("__first_day", F.to_date("__first"))
        table = store.read(spark, hourly_path)
        affected = store.since(table, days[0]).join(first, keys).where(F.col(time_col) >= F.col("__first")).select(*cols)
        context = context_before(table, first, days[0], keys, time_col, context_rows).select(*cols)
        both = context.withColumn("__ctx", F.lit(True)).unionByName(affected.withColumn("__ctx", F.lit(False)))
        feats = hourly_features(both, keys, time_col, pollutants).where(~F.col("__ctx")).drop("__ctx")
        store.merge(spark, feats, feature_path, [*keys, time_col], time_col, deletes=gone).forget(spark)
        store.delete(spark, landed)

    return (stream.parquet(source_path).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
