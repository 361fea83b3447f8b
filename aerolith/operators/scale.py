"""Skew-safe ordered operators for few keys or one very long series.

A plain ``Window.partitionBy(keys).orderBy(time)`` sends every row of a key to one
task; a station holding a third of all rows would then be one third of the job in
one task.  These helpers cut each key into blocks of a number of rows and stitch the blocks
back together exactly, whatever the rows' times are:

* R1 ``with_series_rank``: 1-based position of each row within its key.  Rows are
  range-partitioned by (keys, time, tie-break) and, among equal rows, by a row number, and written to the shared
  folder, so that the partitions are fixed; each counts its rows of a key, the counts of the partitions before it
  are the offset (one row for each key and partition), and a ``row_number`` inside (keys, partition) adds the
  local position.
* R2 ``halo_window``: bounded row frames (lags and rolling windows reaching ``reach``
  rows back).  Rank blocks of ``block_rows`` rows; the last ``reach`` rows of each
  block are copied into the next block as halo, the window runs over
  (keys, rank block) and halo rows are dropped: a window partition has at most ``block_rows + reach`` rows.
* R3 ``carry_fill``: unbounded look-back (forward fill).  Fill inside each rank
  block, carry the last non-null of earlier blocks over the small per-block table,
  join back and ``coalesce``.

All three equal the plain window on the same data (``tests/test_scale.py``).  ``longest_series`` is the check that
decides between them and the plain window where a caller leaves the choice to the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.select import materialised

_RANK = "__rank"
_RB = "__rblock"
_HALO = "__halo"
_TIE = "__tie"
_PART = "__part"

DEFAULT_BLOCK_ROWS = 8192
#: Rows of one key that a plain window may hold: more than eleven years of hours.
PLAIN_ROWS = 100_000


def _null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Equi-join on ``cols`` treating NULL keys as equal (pandas semantics)."""
    r = right.select([F.col(c).alias(f"__r_{c}") for c in cols] + [c for c in right.columns if c not in cols])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(r, cond, "left").drop(*[f"__r_{c}" for c in cols])


def longest_series(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the key that has most (one aggregate; a key's rows are counted where they are)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def with_series_rank(df: DataFrame, keys: Sequence[str], time_col: str = "time", tiebreak: Sequence[str] = (), rank_col: str = _RANK) -> DataFrame:
    """Add ``rank_col`` = 1-based row position per key in (time, tiebreak) order.  Writes ``df`` once, range-partitioned."""
    keys, order = list(keys), [time_col, *tiebreak, _TIE]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(parts, *keys, *order)
    placed = materialised(placed.withColumn(_PART, F.spark_partition_id()), "ranked")
    counts = placed.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, _PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    joined = _null_safe_join(placed, offsets, [*keys, _PART])
    local = F.row_number().over(Window.partitionBy(*keys, _PART).orderBy(*order))
    return joined.withColumn(rank_col, (F.col("__off") + local).cast("bigint")).drop("__off", _PART, _TIE)


def _block(block_rows: int) -> Column:
    return F.floor((F.col(_RANK) - 1) / F.lit(block_rows)).cast("bigint")


def halo_window(df: DataFrame, keys: Sequence[str], build: Callable[[str], dict[str, Column]],
                reach: int, time_col: str = "time", tiebreak: Sequence[str] = (),
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """R2: evaluate ``build(window)`` (row frames reaching <= ``reach`` rows back) per key.

    ``build`` receives the SQL window clause body (``PARTITION BY ... ORDER BY ...``)
    of the position order and returns the new columns.
    """
    keys = list(keys)
    b = max(int(block_rows), int(reach), 1)
    ranked = with_series_rank(df, keys, time_col, tiebreak).withColumn(_RB, _block(b))
    last_of_block = (F.col(_RANK) - 1) % F.lit(b) >= F.lit(b - reach)
    copies = F.when(last_of_block, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    own = ranked.withColumn("__copy", F.explode(copies))
    own = own.withColumn(_RB, F.col(_RB) + F.col("__copy")).withColumn(_HALO, F.col("__copy") == 1).drop("__copy")
    part = ", ".join(f"`{k}`" for k in [*keys, _RB])
    out = own.withColumns(build(f"PARTITION BY {part} ORDER BY `{_RANK}`"))
    return out.where(~F.col(_HALO)).drop(_RANK, _RB, _HALO)


def carry_fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str], time_col: str = "time",
               tiebreak: Sequence[str] = (), block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Forward fill ``cols`` per key; leading NULLs stay NULL."""
    keys, cols = list(keys), list(cols)
    ranked = materialised(with_series_rank(df, keys, time_col, tiebreak).withColumn(_RB, _block(block_rows)), "filled")
    last_in_block = ranked.groupBy(*keys, _RB).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_RANK))).alias(f"__last_{c}") for c in cols])
    w_carry = Window.partitionBy(*keys).orderBy(_RB).rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_block.select(
        *keys, _RB, *[F.last(f"__last_{c}", ignorenulls=True).over(w_carry).alias(f"__carry_{c}") for c in cols])
    joined = _null_safe_join(ranked, carry, [*keys, _RB])
    w_local = Window.partitionBy(*keys, _RB).orderBy(_RANK).rowsBetween(Window.unboundedPreceding, 0)
    filled = joined.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w_local), F.col(f"__carry_{c}")) for c in cols})
    return filled.select(*df.columns)
