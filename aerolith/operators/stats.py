"""Descriptive statistics.

Every operator is one aggregation pass (partial + final hash aggregate) followed by a
cheap unpivot of the one-row-per-group result; ``keys`` gives per-station results.

Quantiles are exact with linear interpolation (pandas, numpy) by radix selection (``operators.select``): a few more passes over
the values, which are written to the shared folder once, with counters in place of a map of values.  ``approx=True`` takes
``percentile_approx`` in the one pass instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators import select

_Q = [0.25, 0.5, 0.75]


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def inline_sql(rows: list[list[tuple[str, str]]]) -> "Column":
    """``inline(array(struct(...), ...))`` from SQL text: one JVM call for the whole unpivot.

    ``rows`` is a list of structs, each a list of (SQL expression, field name).
    """
    structs = ", ".join("struct(" + ", ".join(f"{e} AS `{n}`" for e, n in r) + ")" for r in rows)
    return F.expr(f"inline(array({structs}))")


def attach_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a one-row-per-group stats table back onto the rows of each group.

    With no keys the stats table has exactly one row (a global aggregate), so it is
    broadcast (size proven) through an equi-join on a constant, not a cross join.
    """
    keys = list(keys)
    if keys:
        return df.join(stats, keys, "inner")
    return df.withColumn("__g", F.lit(0)).join(F.broadcast(stats.withColumn("__g", F.lit(0))), "__g").drop("__g")


def pearson(a, b) -> Column:
    """Pairwise-complete Pearson correlation as an aggregate; NaN for a constant input or a single pair.

    Spark's ``corr`` divides by zero for a constant column, which raises under ANSI
    mode; pandas answers NaN.  Rows where either side is NULL are skipped (pandas'
    pairwise-complete rule).
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    xa, xb = F.when(both, a).cast("double"), F.when(both, b).cast("double")
    den = F.stddev_samp(xa) * F.stddev_samp(xb)
    return F.when((den == 0) | (F.count(xa) == 1), F.lit(float("nan"))).otherwise(F.try_divide(F.covar_samp(xa, xb), den))


def describe(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """``DataFrame.describe()`` (A1, A2) in long form: keys, column, count, mean, std, min, p25, p50, p75, max.

    Columns are unpivoted by a generator and aggregated per (keys, column): one small
    aggregate plan whatever the number of columns.  NaN counts as missing.
    """
    keys, names = list(keys), ["p25", "p50", "p75"]
    long = df.select(*keys, inline_sql([[(_lit(c), "column"), (f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))", "x")] for c in cols]))
    basics = [F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")]
    if approx:
        out = long.groupBy(*keys, "column").agg(*basics, F.percentile_approx("x", _Q, 100_000).alias("__q"))
        out = out.withColumns({n: F.col("__q")[i].cast("double") for i, n in enumerate(names)})
    else:
        long = select.materialised(long, "described")
        q = select.quantiles(long, _Q, [*keys, "column"]).drop("n")
        out = long.groupBy(*keys, "column").agg(*basics)
        out = _beside(out, q.select(*keys, "column", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)]), [*keys, "column"])
        if not keys:  # a table without rows still has its columns
            every = df.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(cols)], "column string")
            out = every.join(out, "column", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select(*keys, "column", "count", "mean", "std", "min", *names, "max")


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join on ``by``, missing keys being equal to each other."""
    cond = F.lit(True)
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(right.withColumnsRenamed({c: f"__r_{c}" for c in by}), cond, "left").drop(*[f"__r_{c}" for c in by])


#: Spread of a column, relative to its size, below which it counts as constant (its correlation is NaN).
CONSTANT = 1e-12


def co_moments(df: DataFrame, cols: Sequence[str], keys: Sequence[str], shift: Sequence[float]) -> DataFrame:
    """keys..., i, j, n, s, q, p: over the rows where columns i and j are both present, their number and the sums of x, x * x and x * y, where x
    is column i and y column j, less its ``shift``.

    Each task adds up one matrix of each kind for a key, batch by batch as matrix products of the values and the mask of those present, and emits
    it once; the matrices of all tasks are summed.
    """
    import numpy as np
    import pyarrow as pa

    keys, c, off = list(keys), len(cols), np.array(shift, float)
    key_fields = [f for f in df.schema.fields if f.name in keys]

    def sums(batches):
        total: dict = {}
        for batch in batches:
            x = np.column_stack([batch.column(len(keys) + i).to_numpy(zero_copy_only=False) for i in range(c)]).astype(float)
            present = ~np.isnan(x)
            x = np.where(present, x - off, 0.0)
            if keys:
                table = pa.Table.from_batches([batch]).select(keys).append_column("__at", pa.array(np.arange(len(x))))
                parts = table.group_by(keys, use_threads=False).aggregate([("__at", "list")]).to_pylist()
                groups = [(tuple(g[k] for k in keys), np.array(g["__at_list"])) for g in parts]
            else:
                groups = [((), slice(None))]
            for key, at in groups:
                m, v = present[at].astype(float), x[at]
                part = np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
                total[key] = total[key] + part if key in total else part
        for key, part in total.items():
            cols_ = [pa.array([v], type=t) for v, t in zip(key, key_types, strict=True)]
            yield pa.RecordBatch.from_arrays([*cols_, *[pa.array([part[k].ravel().tolist()]) for k in range(4)]], names=[*keys, "n", "s", "q", "p"])

    from pyspark.sql.pandas.types import to_arrow_type

    key_types = [to_arrow_type(df.schema[k].dataType) for k in keys]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in sorted(key_fields, key=lambda f: keys.index(f.name))],
                        *[f"{k} array<double>" for k in "nsqp"]])
    each = df.select(*keys, *[F.col(x).cast("double") for x in cols]).mapInArrow(sums, schema)
    cells = each.select(*keys, F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("__at", "__m"))
    return cells.groupBy(*keys, "__at").agg(*[F.sum(f"__m.{k}").alias(k) for k in "nsqp"]).select(
        *keys, F.floor(F.col("__at") / c).cast("int").alias("i"), (F.col("__at") % c).alias("j"), "n", "s", "q", "p")


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pairwise-complete Pearson matrix (A3) in long form (keys, a, b, r), both triangles and diagonal.

    One pass of masked co-moment matrices (``co_moments``) after a pass for the means, by which the values are shifted so that the
    sums do not cancel.  NaN counts as missing; r is NaN for a single pair or a constant column, NULL without a pair.
    ``df`` is written to the shared folder once; a task sends one matrix for each key, whatever its rows.
    """
    keys, cols = list(keys), list(cols)
    value = lambda x: F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double"))
    rows = select.materialised(df.select(*keys, *[value(x).alias(x) for x in cols]), "correlated")
    means = rows.agg(*[F.coalesce(F.avg(x), F.lit(0.0)) for x in cols]).first()
    m = co_moments(rows, cols, keys, list(means))
    other = m.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("j").alias("__i"), F.col("i").alias("__j"), F.col("s").alias("__s"), F.col("q").alias("__q"))
    same = (F.col("i") == F.col("__i")) & (F.col("j") == F.col("__j"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    spread = lambda s, q: F.col(q) - F.col(s) * F.col(s) / F.col("n")
    size = F.array(*[F.lit(float(x)) for x in means])
    flat = lambda s, q, i: spread(s, q) <= F.col("n") * F.pow(F.lit(CONSTANT) * F.greatest(F.abs(size[F.col(i)]), F.sqrt(F.col(q) / F.col("n"))), F.lit(2.0))
    r = (F.col("p") - F.col("s") * F.col("__s") / F.col("n")) / F.sqrt(spread("s", "q") * spread("__s", "__q"))
    constant = (F.col("n") == 1) | flat("s", "q", "i") | flat("__s", "__q", "j")
    r = F.when(F.col("n") == 0, F.lit(None).cast("double")).when(constant, F.lit(float("nan"))).otherwise(F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    name = F.array(*[F.lit(x) for x in cols])
    return m.join(other, same).select(*keys, name[F.col("i")].alias("a"), name[F.col("j")].alias("b"), r.alias("r"))


def corr_with_target(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of each feature with ``target`` ranked high to low.

    NaN (a constant feature) ranks last, as pandas ``sort_values`` puts it.
    """
    keys = list(keys)
    pairs = df.select(*keys, inline_sql([[(_lit(f), "feature"), (f"CAST(`{f}` AS DOUBLE)", "x"),
                                           (f"CAST(`{target}` AS DOUBLE)", "y")] for f in features]))
    long = pairs.groupBy(*keys, "feature").agg(pearson("x", "y").alias("r"))
    missing = F.col("r").isNull() | F.isnan(F.col("r"))
    w = Window.partitionBy(*keys).orderBy(missing.asc(), F.col("r").desc(), F.col("feature").asc())
    return long.withColumn("rank", F.row_number().over(w).cast("int"))


def autocorr(df: DataFrame, col: str, lags: Sequence[int], keys: Sequence[str] = ("station",),
             time_col: str = "time", tiebreak: Sequence[str] = (), strategy: str = "auto") -> DataFrame:
    """``Series.autocorr(lag)`` (A5): corr(x, x shifted by ``lag`` rows) per key.

    The shifts are those of ``windows.lag_features``: a long key is cut into rank blocks of bounded rows (``strategy`` as there).
    """
    from aerolith.operators import windows

    keys = list(keys)
    series = select.materialised(df.select(*keys, time_col, *tiebreak, F.col(col).cast("double").alias("__x")), "series")
    lagged = windows.lag_features(series, ["__x"], lags, keys, time_col, tiebreak, strategy)
    wide = lagged.groupBy(*keys).agg(*[pearson("__x", f"__x_lag_{k}h").alias(f"a{k}") for k in lags])
    return wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(f"a{k}").alias("autocorr")) for k in lags])))


def histogram(df: DataFrame, col: str, bins: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram (A14) with every bin, empty ones included: keys, bins, bin, lo, hi, count.

    Bin ``i`` covers ``[lo_i, hi_i)``; the maximum joins the last bin (numpy rule).  All bin counts come from one pass over the values, which
    are written to the shared folder once; their range (one row per group) gives the edges.
    """
    keys, bins = list(keys), list(dict.fromkeys(bins))
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = select.materialised(df.select(*keys, x.alias("__x")), "histogram")
    rng = select.materialised(vals.groupBy(*keys).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx")), "histogram-range")
    span = F.col("__mx") - F.col("__mn")

    def bin_of(n: int) -> Column:
        return F.when(span > 0, F.least(F.floor((F.col("__x") - F.col("__mn")) * F.lit(float(n)) / span), F.lit(n - 1))).otherwise(F.lit(0)).cast("int")

    placed = attach_group_stats(vals.where(F.col("__x").isNotNull()), rng, keys)
    placed = placed.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("bins"), bin_of(n).alias("bin")) for n in bins])))
    counts = placed.groupBy(*keys, "bins", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*keys, "__mn", "__mx", F.explode(F.array(*[F.lit(n) for n in bins])).alias("bins"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    edge = lambda i: F.col("__mn") + i * span / F.col("bins").cast("double")
    edges = grid.select(*keys, "bins", "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"))
    return _beside(edges, counts, [*keys, "bins", "bin"]).withColumn("count", F.coalesce("count", F.lit(0)))


#: Bandwidths beyond which a value adds nothing to a density in double precision: exp(-8.5 ** 2 / 2) is 2e-16.
KDE_REACH = 8.5


def kde_grid(df: DataFrame, col: str, gridsize: int = 200, keys: Sequence[str] = ()) -> DataFrame:
    """Gaussian KDE on ``gridsize`` points from min to max (A15), Scott bandwidth.

    density(g) = sum_i exp(-((g - x_i)/h)^2 / 2) / (n h sqrt(2 pi)),  h = n^(-1/5) * std.
    Distinct values are counted first (partial aggregation); each then adds to the grid points within ``KDE_REACH`` bandwidths
    (``kde_terms``), and the (keys, grid point) sums are again partially aggregated.  A point that no value reaches has density 0.
    """
    keys = list(keys)
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = select.materialised(df.select(*keys, x.alias("__x")).where(F.col("__x").isNotNull()), "kde")
    st = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp("__x").alias("__sd"), F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    st = st.withColumn("__h", F.pow(F.col("__n").cast("double"), F.lit(-0.2)) * F.col("__sd"))
    st = select.materialised(st.withColumn("__step", (F.col("__mx") - F.col("__mn")) / F.lit(float(gridsize - 1))), "kde-groups")
    sums = kde_terms(vals, st, gridsize, keys).groupBy(*keys, "point").agg(F.sum("__kern").alias("__sum"))
    grid = st.select(*keys, "__n", "__h", "__mn", "__step", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    norm = F.col("__n").cast("double") * F.col("__h") * F.lit(math.sqrt(2 * math.pi))
    density = F.when(F.col("__h") > 0, F.coalesce("__sum", F.lit(0.0)) / norm)  # a constant has no density
    return _beside(grid, sums, [*keys, "point"]).select(*keys, "point", (F.col("__mn") + F.col("point") * F.col("__step")).alias("x"), density.alias("density"))


def kde_terms(vals: DataFrame, st: DataFrame, gridsize: int, keys: Sequence[str]) -> DataFrame:
    """keys..., point, __kern: what each distinct value of ``vals`` adds to the grid points in its reach."""
    keys = list(keys)
    distinct = vals.groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__w"))
    joined = attach_group_stats(distinct, st, keys).where("__h > 0 and __step > 0")
    at = lambda side: (F.col("__x") + F.lit(side * KDE_REACH) * F.col("__h") - F.col("__mn")) / F.col("__step")
    first = F.greatest(F.ceil(at(-1)), F.lit(0)).cast("int")
    last = F.least(F.floor(at(1)), F.lit(gridsize - 1)).cast("int")
    pts = joined.withColumns({"__first": first, "__last": last}).where("__first <= __last")
    pts = pts.select(*keys, "__x", "__w", "__h", "__mn", "__step", F.explode(F.sequence("__first", "__last")).alias("point"))
    u = (F.col("__mn") + F.col("point") * F.col("__step") - F.col("__x")) / F.col("__h")
    return pts.select(*keys, "point", (F.col("__w") * F.exp(-(u * u) / F.lit(2.0))).alias("__kern"))


def box_stats(df: DataFrame, col: str, keys: Sequence[str] = (), whis: float = 1.5) -> DataFrame:
    """Box-plot numbers (A16): quartiles, whiskers (last points within whis*IQR), outlier count."""
    keys = list(keys)
    rows = select.materialised(df.select(*keys, F.col(col).cast("double").alias("__x")).where(F.col("__x").isNotNull()), "boxes")
    joined = attach_group_stats(rows, _quartiles(rows, "__x", keys), keys)
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - F.lit(whis) * iqr
    hi_fence = F.col("q3") + F.lit(whis) * iqr
    inside = (F.col("__x") >= lo_fence) & (F.col("__x") <= hi_fence)
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def _quartiles(rows: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    q = select.quantiles(rows, _Q, keys, value)
    return q.select(*keys, *[F.col(f"q{i}").alias(n) for i, n in enumerate(["q1", "median", "q3"])])


def outlier_filter(df: DataFrame, col: str, keys: Sequence[str] = (), whis: float = 1.5) -> DataFrame:
    """Drop rows outside the box-plot fences of ``col`` (per key)."""
    keys = list(keys)
    rows = select.materialised(df, "filtered")
    q = _quartiles(rows, col, keys).select(*keys, F.col("q1").alias("__q1"), F.col("q3").alias("__q3"))
    j = attach_group_stats(rows, q, keys)
    iqr = F.col("__q3") - F.col("__q1")
    keep = (F.col(col) >= F.col("__q1") - F.lit(whis) * iqr) & (F.col(col) <= F.col("__q3") + F.lit(whis) * iqr)
    return j.where(keep).drop("__q1", "__q3")
