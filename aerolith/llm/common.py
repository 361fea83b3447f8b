"""Shared helpers of the operators: tables, written intermediate tables, distributed running sums."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.config import checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space (fixed pattern).
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing lazy reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers each that may be broadcast; a larger side is joined by a shuffle.
BROADCAST_ROWS = 1 << 21


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if it was counted to be at most BROADCAST_ROWS long."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def width(spark: SparkSession) -> int:
    """Partitions for explicit range or hash partitioning: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, name: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to and with the row, by ``keys``, in ``order``; no key lands whole in one task.

    Rows are range-partitioned by (keys, order) and, among equal rows, by a row number, so neither a hot key nor a row
    that repeats many times lands in one partition.  Each partition sums its own rows; the sums of the partitions before it (one row for each
    partition and key) are added.  Rows equal in ``order`` may swap places.  The result is a
    written table, so that the partition numbers are fixed.
    """
    spark = df.sparkSession
    cols = [F.col(c) for c in [*keys, *order, "__tie"]]
    placed = written(
        df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(width(spark), *cols).withColumn("__pid", F.spark_partition_id()), f"{name}-ranged")
    part = placed.groupBy(*keys, "__pid").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__pid").alias("__bpid"),
                       F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy(*keys, "__pid").orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("__own", F.sum(value).over(own))
    cond = F.col("__pid") == F.col("__bpid")
    for i, k in enumerate(keys):
        cond &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return (inside.join(part, cond).withColumn(out, F.col("__own") + F.col("__before"))
            .select(*df.columns, out))
