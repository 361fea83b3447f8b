"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Quantise every floating column to a 10^-places grid (output normalisation).

    Float sums depend on evaluation order, so engines differ in the last bits.  Both
    this function and the SQL twins apply the same IEEE arithmetic,
    ``floor(x * 10^p + 0.4999) / 10^p``, whose bucket edges sit 1e-4 of a unit away
    from decimal ties: averages of cent values often end exactly in a 5 at the
    seventh place, where a decimal HALF_UP and a binary round disagree.
    """
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: quantize(c, places) for c in fl}) if fl else df


def quantize(name: str, places: int = 6):
    """NaN and infinities pass through unchanged.  Built as one SQL expression string
    (one call into the JVM instead of one per operator node)."""
    scale = f"CAST({10 ** places} AS DOUBLE)"
    x = f"`{name}`"
    return F.expr(f"CASE WHEN isnan({x}) OR abs({x}) = CAST('Infinity' AS DOUBLE) THEN {x} "
                  f"ELSE CAST(floor({x} * {scale} + CAST(0.4999 AS DOUBLE)) / {scale} AS DOUBLE) END")
