"""Exact order statistics in bounded memory: radix selection on order-preserving integers.

The value at a rank is found digit by digit, from the first bit in which values differ.  Each pass counts, for the rows that share the digits found so far, how many
fall on each next digit (a partial aggregate: a task holds and sends counters, at most 2**BITS for each wanted rank, never
the rows or a map of values), adds the counters up in order and keeps the digit that holds the rank.  It stops as soon as
all rows of that digit are equal, six passes at most.  So neither a hot group nor a column of distinct values lands in one task,
and nothing is sorted but counters.

Doubles are compared by a 64-bit integer in the same order (sign, exponent, mantissa; ``with_double_key``), built from exact arithmetic;
NaN and NULL have none and take no part.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from aerolith.config import scratch_path
from aerolith.functions.timeutil import epoch_micros

#: Digits: counters of a pass for each wanted rank, at most 2**BITS.
BITS = 16
_TWO52 = float(1 << 52)
_INF_KEY = 2047 << 52


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, with its schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``materialised`` that nothing lazy reads any more."""
    from aerolith.sources.store import delete

    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            delete(df.sparkSession, folder)


def with_double_key(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``out``, a long that sorts as the double ``value`` does; NULL for NULL and NaN.  0.0 and -0.0 are one value.

    In steps, so that the logarithm and the power of two are computed once a row.
    """
    a, e, p = F.col("__a"), F.col("__e"), F.col("__p")
    df = df.withColumn("__x", F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
    df = df.withColumn("__a", F.least(F.abs("__x"), F.lit(sys.float_info.max)))
    df = df.withColumn("__e", F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1022)).cast("long"))  # may be off by one
    df = df.withColumn("__p", F.pow(F.lit(2.0), e.cast("double")))
    df = df.withColumn("__off", F.when((a < p) & (e > -1022), -1).when((a / p >= 2) & (e < 1023), 1).otherwise(0))
    exact = F.when(F.col("__off") == -1, p / 2).when(F.col("__off") == 1, p * 2).otherwise(p)
    df = df.withColumn("__size", (a / exact * F.lit(_TWO52)).cast("long") + (e + F.col("__off") + 1022) * F.lit(1 << 52))
    size = F.when(a == 0, F.lit(0).cast("long")).when(F.abs("__x") == F.lit(float("inf")), F.lit(_INF_KEY)).otherwise(F.col("__size"))
    key = F.when(F.col("__x") < 0, -size).otherwise(size)
    return df.withColumn(out, F.when(F.col("__x").isNotNull(), key)).drop("__x", "__a", "__e", "__p", "__off", "__size")


def key_double(key: Column) -> Column:
    """The double of a key that ``with_double_key`` made."""
    size = F.abs(key)
    biased = F.call_function("shiftright", size, F.lit(52))
    mantissa = size.bitwiseAND(F.lit((1 << 52) - 1))
    mantissa = F.when(biased == 0, mantissa).otherwise(mantissa + F.lit(1 << 52))
    e = F.greatest(biased, F.lit(1)) - 1023
    a = mantissa.cast("double") / F.lit(_TWO52) * F.pow(F.lit(2.0), F.least(e, F.lit(1023)).cast("double"))
    a = F.when(size == F.lit(_INF_KEY), F.lit(float("inf"))).otherwise(a)
    return F.when(key < 0, -a).otherwise(a)


def with_order_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``__k0``, ``__k1``, ...: longs that sort as the columns do (times, numbers, booleans; NULL first)."""
    for i, column in enumerate(columns):
        kind, out = df.schema[column].dataType.typeName(), f"__k{i}"
        if kind in ("timestamp", "timestamp_ntz"):
            df = df.withColumn(out, epoch_micros(column))
        elif kind == "date":
            df = df.withColumn(out, F.unix_date(F.col(column)).cast("long"))
        elif kind in ("byte", "short", "integer", "long", "boolean"):
            df = df.withColumn(out, F.col(column).cast("long"))
        elif kind in ("float", "double"):
            df = with_double_key(df, column, out)
        else:
            raise ValueError(f"column {column!r} of type {kind} has no integer order")
        df = df.withColumn(out, F.coalesce(out, F.lit(-(1 << 63)).cast("long")))
    return df


def _same(by: Sequence[str]) -> Column:
    """The ``by`` columns equal those named __w_..., missing ones included."""
    out = F.lit(True)
    for c in by:
        out = out & F.col(c).eqNullSafe(F.col(f"__w_{c}"))
    return out


def select(rows: DataFrame, wanted: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """``wanted`` (``by``, rank from 0, and other columns) with ``key``: the value at that rank among the ``rows`` with the same ``by``,
    in ascending order of the long column ``key``; ``rank`` becomes the rank among the rows with that value.

    ``rows`` should be a materialised table; rows without a key must not be in it.  A rank beyond the rows gives none.
    """
    by = list(by)
    rest = [c for c in wanted.columns if c != "rank"]
    names = {c: f"__w_{c}" for c in by}
    todo = wanted.withColumns({"__above": F.lit(0).cast("long"), "__found": F.lit(None).cast("long")})
    least, most = rows.agg(F.min(key), F.max(key)).first()
    shift = 0 if least is None else (least ^ most if least >= 0 or most < 0 else (1 << 64) - 1).bit_length()  # the bits above are the same in all rows
    above = None
    while True:
        shift = max(0, shift - BITS)
        digit = F.call_function("shiftright", F.col(key), F.lit(shift))
        open_ = todo if above is None else todo.where("__found is null")
        if above is None:
            here = rows.withColumn("__a", F.lit(0).cast("long"))
        else:
            asked = open_.select(*by, F.col("__above").alias("__w")).distinct().withColumnsRenamed(names)
            here = rows.withColumn("__a", above).join(asked, (F.col("__a") == F.col("__w")) & _same(by), "left_semi")
        cells = here.groupBy(*by, "__a", digit.alias("__cell")).agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__least"), F.max(key).alias("__most"))
        upto = F.sum("__n").over(Window.partitionBy(*by, "__a").orderBy("__cell"))
        cells = cells.withColumn("__upto", upto).withColumnsRenamed(names)
        held = (F.col("__above") == F.col("__a")) & (F.col("rank") < F.col("__upto")) & (F.col("rank") >= F.col("__upto") - F.col("__n"))
        one = F.when(F.col("__least") == F.col("__most"), F.col("__least"))
        picked = open_.join(cells, held & _same(by)).select(
            *rest, (F.col("rank") - F.col("__upto") + F.col("__n")).alias("rank"), F.col("__cell").alias("__above"), one.alias("__found"))
        left = Observation()
        every = picked if above is None else picked.unionByName(todo.where("__found is not null"))
        last, todo = todo, materialised(every.observe(left, F.count_if(F.col("__found").isNull()).alias("open")), "ranks")
        if above is not None:
            dropped(last)
        if shift == 0 or not left.get["open"]:
            return todo.drop("__above").withColumnRenamed("__found", key)
        above = digit


def quantiles(rows: DataFrame, probs: Sequence[float], by: Sequence[str] = (), value: str = "x") -> DataFrame:
    """by..., n, q0, q1, ...: the exact quantiles of the double column ``value`` with linear interpolation (pandas, numpy); NULL and NaN are left out.

    A group without values gives no row.  The keys of the values are written to the shared folder once.
    """
    by, probs = list(by), [float(p) for p in probs]
    there = rows.select(*by, F.col(value).cast("double").alias("__value")).where("__value is not null and not isnan(__value)")
    keyed = materialised(with_double_key(there, "__value", "__key").select(*by, "__key"), "keys")  # a filter on the key would compute it in the filter
    sizes = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    place = lambda p: (F.col("n") - 1).cast("double") * F.lit(p)
    ends = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(side).alias("high"), (F.ceil(place(p)) if side else F.floor(place(p))).cast("long").alias("rank"))
                               for i, p in enumerate(probs) for side in (0, 1)]))
    wanted = sizes.select(*by, "n", ends.alias("__e")).select(*by, "n", "__e.q", "__e.high", "__e.rank")
    found = select(keyed, wanted, by, "__key").withColumn("__v", key_double(F.col("__key")))
    dropped(keyed)
    at = lambda i, high: F.max(F.when((F.col("q") == i) & (F.col("high") == high), F.col("__v")))
    wide = found.groupBy(*by, "n").agg(*[at(i, s).alias(f"__{i}_{s}") for i in range(len(probs)) for s in (0, 1)])
    between = lambda i, p: F.col(f"__{i}_0") + F.when(F.col(f"__{i}_1") == F.col(f"__{i}_0"), F.lit(0.0)).otherwise(
        (F.col(f"__{i}_1") - F.col(f"__{i}_0")) * (place(p) - F.floor(place(p))))
    return wide.select(*by, "n", *[between(i, p).alias(f"q{i}") for i, p in enumerate(probs)])


def row_at(df: DataFrame, order: Sequence[str], wanted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``wanted`` (``by``, rank from 0) with the order keys ``__k0``, ``__k1``, ... of the row at that rank of its
    group, rows in ascending ``order`` (NULL first).  Equal rows have equal keys; ``rank`` becomes the rank among them."""
    by, keys = list(by), [f"__k{i}" for i in range(len(order))]
    rows = materialised(with_order_keys(df.select(*dict.fromkeys([*by, *order])), order).select(*by, *keys), "order")
    for i, k in enumerate(keys):
        wanted = select(rows, wanted, [*by, *keys[:i]], k)
    dropped(rows)
    return wanted


def after(n: int, marks: Sequence[Column]) -> Column:
    """Whether a row with ``n`` order keys comes after the one with these."""
    out = F.lit(False)
    for i in reversed(range(n)):
        own = F.col(f"__k{i}")
        out = (own > marks[i]) | ((own == marks[i]) & out)
    return out
