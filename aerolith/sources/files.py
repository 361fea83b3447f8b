"""File sources: CSV with a metadata preamble (S1), plain CSV (S2), hourly API payloads
(S3), chunked back-fill bookkeeping (S4), frame concatenation (U1) and name cleaning (P3).

Everything is a Spark read or a Column transformation: the preamble reader is
splittable (lines are filtered by pattern, so a preamble anywhere in any part file is
skipped), the payload reader explodes arrays inside each task, and the chunk table is a
generator over a date range.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aerolith.functions.timeutil import from_epoch_seconds
from aerolith.operators.clean import nan_to_null

DATA_LINE = r"^\d{4}-\d{2}-\d{2}T"
CSV_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
NAME_RULE = re.compile(r"^[a-z][a-z0-9_]*$")
_SEPARATORS = str.maketrans(" -", "__")


class Names(NamedTuple):
    """What a table's column names become, and what is wrong with them."""

    clean: dict[str, str]
    collisions: dict[str, list[str]]  # clean name -> the columns that share it
    invalid: list[str]  # clean names that break NAME_RULE


def normalise_names(columns: Sequence[str]) -> Names:
    """P3 + F17: the label before the unit in parentheses, as lower-case words joined by ``_``."""
    clean = {}
    for column in columns:
        label, _, _unit = column.partition("(")
        clean[column] = label.strip().translate(_SEPARATORS).lower()
    shared: dict[str, list[str]] = {}
    for column in columns:
        shared.setdefault(clean[column], []).append(column)
    return Names(clean, {n: c for n, c in shared.items() if len(c) > 1}, [n for n in shared if not NAME_RULE.match(n)])


def rename_clean(df: DataFrame, validate: bool = True) -> DataFrame:
    """P3 + F17 on a DataFrame's schema (driver-side names only, no data movement).

    Raises on two columns with one clean name or on a name breaking the rule
    ``^[a-z][a-z0-9_]*$`` (the reference leaves both unchecked).
    """
    names = normalise_names(df.columns)
    if names.collisions:
        raise ValueError(f"cleaned column names collide: {names.collisions}")
    if validate and names.invalid:
        raise ValueError(f"column names break ^[a-z][a-z0-9_]*$: {names.invalid}")
    return df.withColumnsRenamed(names.clean)


#: The column that takes a line that does not fit the schema.
CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: StructType, time_format: str | None = None) -> DataFrame:
    """Plain CSV with a header, explicit schema (no inference pass); the rows that fit it.

    Empty cells and NaN are NULL (the reference's one missing marker).  A line with a cell that does not parse or with
    too many cells is left out here and given by ``rejected_lines``.
    """
    rows = _landed(spark, path, schema, time_format)
    return nan_to_null(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT))


def rejected_lines(spark: SparkSession, path: str, schema: StructType, time_format: str | None = None) -> DataFrame:
    """The reject table of ``read_csv``: line, file, and the cells that did parse."""
    rows = _landed(spark, path, schema, time_format)
    return rows.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "line").withColumn("file", F.input_file_name())


def load_csv(spark: SparkSession, path: str, schema: StructType, good: str, rejects: str, time_format: str | None = None) -> dict[str, int]:
    """S2 as a job: write the rows that fit to the table ``good`` and the lines that do not to ``rejects`` (append); the counts come from the
    writes themselves (``observe``)."""
    counts = {}
    for name, df, place in (("rows", read_csv(spark, path, schema, time_format), good), ("rejected", rejected_lines(spark, path, schema, time_format), rejects)):
        seen = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(place)
        counts[name] = seen.get["n"]
    return counts


def _landed(spark: SparkSession, path: str, schema: StructType, time_format: str | None) -> DataFrame:
    r = spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
    r = r.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("nanValue", "NaN").option("enforceSchema", True)
    if time_format:
        r = r.option("timestampNTZFormat", time_format).option("timestampFormat", time_format)
    return r.csv(path)


def read_csv_preamble(spark: SparkSession, path: str, schema: StructType,
                      time_format: str = CSV_TIME_FORMAT, data_line: str = DATA_LINE) -> DataFrame:
    """CSV whose files start with metadata lines and a unit-bearing header.

    Only lines that start like a timestamp are data; each is parsed with ``from_csv``
    against ``schema`` (whose field names are the cleaned header names).
    """
    lines = spark.read.text(path)
    parsed = lines.where(F.col("value").rlike(data_line)).select(
        F.from_csv(F.col("value"), schema.simpleString()[len("struct<"):-1].replace(":", " "),
                   {"timestampNTZFormat": time_format, "timestampFormat": time_format}).alias("r"))
    return parsed.select("r.*")


def header_names(spark: SparkSession, path: str, first_field: str = "time") -> list[str]:
    """The raw header of a preamble CSV (one line read on the driver, schema-level)."""
    row = spark.read.text(path).where(F.col("value").startswith(first_field)).limit(1).collect()
    if not row:
        raise ValueError(f"no header line starting with {first_field!r} in {path}")
    return row[0]["value"].split(",")


def write_csv_preamble(spark: SparkSession, df: DataFrame, path: str, header: Sequence[str],
                       preamble: Sequence[str], time_col: str = "time", time_format: str = CSV_TIME_FORMAT) -> None:
    """Write ``df`` in the preamble layout (used to land test inputs; the lines are built by Spark)."""
    fields = [F.date_format(F.col(time_col), time_format)] + [
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != time_col]
    data = df.select(F.concat_ws(",", *fields).alias("value"))
    head = spark.createDataFrame([(x,) for x in [*preamble, ",".join(header)]], "value string")
    head.unionByName(data).write.mode("overwrite").text(path)


def payload_explode(payload: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("station",)) -> DataFrame:
    """S3 + F5 + F6: ``struct(start, end, interval, <var>: array<double>)`` rows -> hourly rows.

    ``time`` = ``date_range(start, end, freq=interval, inclusive='left')``; the i-th value of
    every variable array goes to the i-th time (a shorter array leaves NULLs at the end, an empty
    range gives no rows, NaN becomes NULL).
    """
    keys = list(keys)
    n = F.greatest(F.ceil((F.col("end") - F.col("start")) / F.col("interval")).cast("int"), F.lit(0))
    steps = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    with_idx = payload.select(*keys, "start", "interval", *variables, F.explode(steps).alias("__i"))
    return with_idx.select(
        *keys,
        from_epoch_seconds(F.col("start") + F.col("__i").cast("bigint") * F.col("interval")).alias("time"),
        *[F.nanvl(F.try_element_at(F.col(v), F.col("__i") + 1), F.lit(None).cast("double")).alias(v) for v in variables])


def hourly_payload(hourly: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("station",),
                   time_col: str = "time") -> DataFrame:
    """Pack hourly rows into one payload per key and UTC day (the API's landed shape).

    Groups are (key, day): at most 24 values each, so the arrays are bounded.
    """
    keys = list(keys)
    day = F.to_date(F.col(time_col))
    hour = F.hour(F.col(time_col))
    g = hourly.groupBy(*keys, day.alias("__day")).agg(*[
        F.map_from_entries(F.collect_list(F.struct(hour, F.col(v)))).alias(f"__m_{v}") for v in variables])
    start = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             F.col("__day").cast("timestamp_ntz"))
    return g.select(*keys, start.alias("start"), (start + 86400).alias("end"), F.lit(3600).cast("bigint").alias(
        "interval"), *[F.transform(F.sequence(F.lit(0), F.lit(23)), _lookup(f"__m_{v}")).alias(v)
                       for v in variables])


def _lookup(map_col: str):
    return lambda h: F.col(map_col)[h]


def chunk_table(ranges: DataFrame, chunk_days: int = 60, start_col: str = "start_date",
                end_col: str = "end_date", keys: Sequence[str] = ()) -> DataFrame:
    """S4 chunk math: [start, start + chunk_days] inclusive, next start = end + 1 day, last end clipped.

    Generated per range row by ``explode(sequence(...))``: no driver loop.
    """
    keys = list(keys)
    step = F.expr(f"INTERVAL {chunk_days + 1} DAYS")
    starts = F.sequence(F.col(start_col), F.col(end_col), step)
    ex = ranges.select(*keys, F.col(end_col).alias("__end"), F.posexplode(starts).alias("chunk", "chunk_start"))
    return ex.select(*keys, F.col("chunk").cast("int").alias("chunk"), "chunk_start",
                     F.least(F.date_add(F.col("chunk_start"), chunk_days), F.col("__end")).alias("chunk_end"))


def missing_chunks(chunks: DataFrame, landed: DataFrame, keys: Sequence[str] = (), time_col: str = "time") -> DataFrame:
    """S4 failure report: chunks with no landed row (left anti join on key and day range).

    The landed side is reduced to distinct (key, day); each chunk expands to its days
    (at most chunk_days + 1), so both joins are equi-joins on (key, day) / (key, chunk).
    """
    keys = list(keys)
    days = landed.select(*keys, F.to_date(F.col(time_col)).alias("__d")).distinct()
    chunk_days = chunks.select(*keys, "chunk", F.explode(F.sequence("chunk_start", "chunk_end")).alias("__d"))
    hit = chunk_days.join(days, [*keys, "__d"], "left_semi").select(*keys, "chunk").distinct()
    return chunks.join(hit, [*keys, "chunk"], "left_anti")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing in a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
