"""Keyed, versioned feature tables on Parquet.

A feature table is a folder ``root/name/v<version>``:

* ``data/commit=<id>/date=<day>``: the rows of a day (UTC, of the event time) as one commit wrote them; never changed afterwards.
* ``stats/commit=<id>/date=<day>``: for each series of that day its rows and its least and largest time, written by the same commit.
* ``_versions/<n>.json``: a version: which commit holds each day, and the schema.  ``_current``: the newest one's number.

**Reading** resolves the version once and reads the folders it names, so a reader keeps its rows whatever is committed
meanwhile; columns and dates are pruned by Spark.  **Writing** (``merge``, S7, D19) writes whole new days beside the old ones
and then creates the next version file, which must not exist: of two writers that started from one version the second
raises ``StaleVersion`` and changes nothing, as does a write that fails before.  ``vacuum`` deletes folders that no kept version names.

**Last write wins** per primary key, also within a batch (of equal keys the largest row, whatever the order of tasks).  A key whose event
time moves to another day leaves the old one: if the time is not part of the key, the days that hold arriving keys are looked up
(only the key columns are read; the arriving keys are the small side).  Only touched days are rewritten.

**High-water marks** (P13, A6) come from the statistics alone: ``high_water`` reads no row of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from aerolith.config import scratch_path

DATE = "date"
_COMMIT = "commit"


class StaleVersion(RuntimeError):
    """The table has a newer version than the one that the write started from."""


def table_path(root: str, name: str, version: int = 1) -> str:
    return f"{root.rstrip('/')}/{name}/v{version}"


# ---------------------------------------------------------------- files


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if there is one already."""
    from py4j.protocol import Py4JJavaError

    fs, p = _fs(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    return True


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file aside and put it in the place of ``path`` in one step."""
    jvm = spark.sparkContext._jvm
    aside = f"{path}-{uuid.uuid4().hex[:12]}"
    _create_text(spark, aside, text)
    _, source = _fs(spark, aside)
    _, place = _fs(spark, path)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(source, place, how)


# ---------------------------------------------------------------- versions


@dataclass
class Version:
    """A committed state of a table: its number (0: no table), the commit of each day, the schema and the series of its statistics."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    schema: dict | None = None
    stats_schema: dict | None = None

    def text(self) -> str:
        return json.dumps({"version": self.number, "parts": self.parts, "schema": self.schema, "stats_schema": self.stats_schema}, sort_keys=True)


def _version_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_versions/{number:010d}.json"


def current(spark: SparkSession, path: str) -> Version:
    """The newest version.  ``_current`` may be one behind a writer that was lost after its commit, so later files are looked for."""
    number = int(_read_text(spark, f"{path.rstrip('/')}/_current") or 0)
    text = _read_text(spark, _version_file(path, number)) if number else None
    while (later := _read_text(spark, _version_file(path, number + 1))) is not None:
        number, text = number + 1, later
    if text is None:
        return Version()
    d = json.loads(text)
    return Version(d["version"], d["parts"], d["schema"], d["stats_schema"])


def _commit(spark: SparkSession, path: str, new: Version) -> None:
    if not _create_text(spark, _version_file(path, new.number), new.text()):
        raise StaleVersion(f"{path} already has version {new.number}")
    _replace_text(spark, f"{path.rstrip('/')}/_current", str(new.number))


def _folders(spark: SparkSession, path: str, kind: str, schema: dict, parts: dict[str, str]) -> DataFrame:
    """The ``kind`` tables of some days, each from its commit's folder."""
    fields = StructType.fromJson(schema)
    full = StructType([*fields.fields, StructField(_COMMIT, StringType()), StructField(DATE, DateType())])
    base = f"{path.rstrip('/')}/{kind}"
    if not parts:
        return spark.createDataFrame([], full).drop(_COMMIT)
    folders = [f"{base}/{_COMMIT}={c}/{DATE}={d}" for d, c in sorted(parts.items())]
    return spark.read.schema(full).option("basePath", base).parquet(*folders).drop(_COMMIT)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame | None:
    """The whole table as of now (or of ``version``), or ``None`` when it does not exist (D7: other errors raise)."""
    version = version or current(spark, path)
    if version.number == 0:
        return None
    return _folders(spark, path, "data", version.schema, version.parts)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete commits that none of the last ``keep`` versions names, and older version files; returns the commits deleted."""
    last = current(spark, path).number
    kept: set[str] = set()
    for n in range(max(1, last - keep + 1), last + 1):
        kept |= set(json.loads(_read_text(spark, _version_file(path, n)))["parts"].values())
    gone = set()
    for kind in ("data", "stats"):
        fs, p = _fs(spark, f"{path.rstrip('/')}/{kind}")
        for f in fs.listStatus(p) if fs.exists(p) else []:
            name = f.getPath().getName()
            if name.startswith(f"{_COMMIT}=") and name.partition("=")[2] not in kept:
                fs.delete(f.getPath(), True)
                gone.add(name.partition("=")[2])
    for n in range(last - keep, 0, -1):
        if not exists(spark, _version_file(path, n)):
            break
        delete(spark, _version_file(path, n))
    return sorted(gone)


# ---------------------------------------------------------------- days


def with_date(df: DataFrame, time_col: str = "time") -> DataFrame:
    return df.withColumn(DATE, F.to_date(F.col(time_col)))


def days_of(df: DataFrame) -> list:
    """The distinct dates of a batch, oldest first (one value a day)."""
    return sorted(r[0] for r in df.select(DATE).distinct().collect() if r[0] is not None)


def on_days(table: DataFrame, days: list) -> DataFrame:
    """Rows of the given dates: literals, so that only their partitions are listed and read."""
    return table.where(F.col(DATE).isin([F.lit(d) for d in days])) if days else table.limit(0)


def since(table: DataFrame, day) -> DataFrame:
    """Rows from ``day`` on, partition-pruned."""
    return table.where(F.col(DATE) >= F.lit(day))


# ---------------------------------------------------------------- writing


@dataclass
class Change:
    """What a merge did: the rows it replaced, moved or deleted as they were (``old``), the rows that took effect (``new``), the days it rewrote."""

    version: Version
    old: DataFrame
    new: DataFrame
    days: list
    scratch: list[str] = field(default_factory=list)

    def forget(self, spark: SparkSession) -> None:
        """Delete the copies of ``old`` and ``new``."""
        for path in self.scratch:
            delete(spark, path)


def _copy(spark: SparkSession, df: DataFrame, name: str, scratch: list[str]) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def matching(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) their key in ``keys``; missing keys are equal to each other."""
    names = keys.columns
    other = keys.select(*[F.col(k).alias(f"__k_{k}") for k in names])
    cond = F.lit(True)
    for k in names:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return rows.join(other, cond, how)


def merge(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], time_col: str = "time", deletes: DataFrame | None = None,
          base: Version | None = None, series: Sequence[str] | None = None) -> Change:
    """Insert-or-replace ``df`` by primary ``keys`` and delete the keys of ``deletes``, as one new version.

    ``df`` is evaluated once.  Rows without a time have no day and are left out (their keys are not touched).  ``base`` is the version that the caller
    has read (default: the newest); if the table has moved on, ``StaleVersion`` is raised.  ``series`` are the keys of the statistics
    (default: the primary keys without the time if it is one of them, else none).
    """
    keys, path = list(keys), path.rstrip("/")
    base = base or current(spark, path)
    series = ([k for k in keys if k != time_col] if time_col in keys else []) if series is None else list(series)
    scratch: list[str] = []
    new = (with_date(df, time_col) if DATE not in df.columns else df).where(F.col(DATE).isNotNull())
    cols = [c for c in new.columns if c != DATE] + [DATE]
    rest = [c for c in cols if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    new = new.groupBy(*keys).agg(F.max_by(row, row).alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*cols)
    new = _copy(spark, new, "merge-new", scratch)
    touched = new.select(*keys)
    if deletes is not None:
        deletes = _copy(spark, deletes.select(*keys).distinct(), "merge-deletes", scratch)
        touched = touched.unionByName(deletes)
    table = read(spark, path, base) if base.number else None
    days, old = set(days_of(new)), None
    if table is not None:
        if time_col not in keys:  # the days that hold arriving keys now
            days |= set(days_of(matching(table.select(*keys, DATE), touched, "left_semi")))
        elif deletes is not None:
            days |= set(days_of(with_date(deletes, time_col)))
        there = on_days(table, sorted(days)).select(*cols)
        old = _copy(spark, matching(there, touched, "left_semi"), "merge-old", scratch)
        merged = matching(there, touched, "left_anti").unionByName(new)
    else:
        merged, old = new, spark.createDataFrame([], new.schema)

    commit = uuid.uuid4().hex[:12]
    data = f"{path}/data/{_COMMIT}={commit}"
    merged.hint("rebalance", DATE).write.partitionBy(DATE).parquet(data)  # files by day; a large day is several tasks' work
    schema = StructType([f for f in merged.schema.fields if f.name != DATE])
    written = spark.read.schema(merged.schema).parquet(data)
    stats = written.groupBy(DATE, *series).agg(F.count(F.lit(1)).alias("n"), F.min(time_col).alias("least"), F.max(time_col).alias("largest"))
    stats = _copy(spark, stats, "merge-stats", scratch)
    stats.hint("rebalance", DATE).write.partitionBy(DATE).parquet(f"{path}/stats/{_COMMIT}={commit}")
    filled = {str(d) for d in days_of(stats)}
    parts = {d: c for d, c in base.parts.items() if d not in {str(x) for x in days}} | dict.fromkeys(sorted(filled), commit)
    version = Version(base.number + 1, parts, json.loads(schema.json()), json.loads(StructType([f for f in stats.schema.fields if f.name != DATE]).json()))
    _commit(spark, path, version)
    return Change(version, old, new, sorted(days), scratch)


def upsert(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], time_col: str = "time") -> DataFrame:
    """S7 without deletions; returns the rows of the touched days."""
    change = merge(spark, df, path, keys, time_col)
    change.forget(spark)
    return on_days(read(spark, path, change.version), change.days)


# ---------------------------------------------------------------- high water


def statistics(spark: SparkSession, path: str, days: list[str] | None = None, version: Version | None = None) -> DataFrame | None:
    """date, series..., n, least, largest of the table's days (or of ``days``), without reading a row of it; ``None`` without a table."""
    version = version or current(spark, path)
    if version.number == 0:
        return None
    parts = version.parts if days is None else {d: c for d, c in version.parts.items() if d in days}
    return _folders(spark, path, "stats", version.stats_schema, parts)


def high_water(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame | None:
    """The stored largest time as ``__hw``, one row, or one for each of ``keys`` (columns of the statistics).

    Without keys only the newest day's statistics are read.
    """
    version = current(spark, path)
    if version.number == 0 or not version.parts:
        return None
    stats = statistics(spark, path, None if keys else [max(version.parts)], version)
    return stats.groupBy(*keys).agg(F.max("largest").alias("__hw"))


def max_time(table: DataFrame, time_col: str = "time", keys: Sequence[str] = ()) -> DataFrame:
    """A6 of any DataFrame: the maximum time (per key when ``keys``), by a scan of that column."""
    return table.groupBy(*keys).agg(F.max(time_col).alias("__hw"))


def rows_after(new: DataFrame, marks: DataFrame | None, time_col: str = "time", keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` strictly after the mark (``__hw``; of their key when ``keys``).  No mark keeps every row."""
    if marks is None:
        return new
    if keys:
        j = new.join(marks, list(keys), "left")
    else:
        j = new.withColumn("__g", F.lit(0)).join(F.broadcast(marks.withColumn("__g", F.lit(0))), "__g", "left").drop("__g")
    return j.where(F.col("__hw").isNull() | (F.col(time_col) > F.col("__hw"))).drop("__hw")


def incremental_rows(new: DataFrame, existing: DataFrame | None, time_col: str = "time",
                     keys: Sequence[str] = ()) -> DataFrame:
    """P13 against any DataFrame: rows of ``new`` strictly after its maximum time (per key when ``keys``).  Of a stored table, use ``high_water``."""
    return rows_after(new, None if existing is None else max_time(existing, time_col, keys), time_col, keys)


def schema_align(df: DataFrame, target_columns: Sequence[str], int_cols: Sequence[str] = (
        "relative_humidity_2m", "wind_direction_10m"), drop: Sequence[str] = ("us_aqi", "cloud_cover"),
        defaults: dict | None = None) -> DataFrame:
    """Shape new rows like the stored table.

    Drop columns the store does not take, add missing store columns with a default
    (``ozone`` = 0.0, D6), turn NULL into 0 and cast to long for the integer columns,
    keep the store's columns in the incoming order (intersection).
    """
    defaults = {"ozone": 0.0} if defaults is None else defaults
    df = df.drop(*[c for c in drop if c in df.columns])
    for c, v in defaults.items():
        if c not in df.columns and c in target_columns:
            df = df.withColumn(c, F.lit(v))
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in int_cols if c in df.columns})
    return df.select([c for c in df.columns if c in set(target_columns)])


def append_history(spark: SparkSession, runs: DataFrame, path: str) -> None:
    """Append run rows to the history table (no rewrite of old runs)."""
    runs.write.mode("append").parquet(path)


def best_by(runs: DataFrame, metric: str = "mae", direction: str = "min", name_col: str = "model_name") -> DataFrame:
    """The best run by ``metric`` (ties: name), a top-1 (TakeOrderedAndProject)."""
    order = F.col(metric).asc() if direction == "min" else F.col(metric).desc()
    return runs.where(F.col(metric).isNotNull()).orderBy(order, F.col(name_col)).limit(1)


def with_fallback(primary: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """``primary`` unless it is missing or empty, else ``fallback`` (schemas by name).

    Decided inside the plan: the fallback rows are kept only when the primary has no
    row; the emptiness probe is ``limit(1)`` of the primary, aggregated to one row.
    """
    if primary is None:
        return fallback
    probe = primary.limit(1).agg(F.count(F.lit(1)).alias("__has")).withColumn("__g", F.lit(0))
    fb = (fallback.withColumn("__g", F.lit(0)).join(F.broadcast(probe), "__g")
          .where(F.col("__has") == 0).drop("__g", "__has"))
    return primary.unionByName(fb, allowMissingColumns=True)


def write_run_metadata(best: DataFrame, path: str) -> None:
    """The best run's row as one JSON record: model, metrics, features, targets, rows trained on, time (F16), folder."""
    best.coalesce(1).write.mode("overwrite").json(path)
