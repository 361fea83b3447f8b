"""Missing-value handling (P8-P11) and the NaN -> NULL rule.

The reference has one missing marker (NaN); Spark keeps NaN and NULL apart, so
every source maps NaN to NULL first, after which ``na.drop``/``avg``/``last(ignorenulls)``
treat missing readings as pandas does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    cols = [c for c in (cols or df.columns) if c in floating]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols})


def value_columns(df: DataFrame, exclude: Sequence[str] = ("station", "time")) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None,
                  exclude: Sequence[str] = ("station", "time")) -> DataFrame:
    """``dropna(subset, how='all')`` (P9): drop rows where every reading is missing."""
    return df.na.drop(how="all", subset=list(subset or value_columns(df, exclude)))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna()`` (P10) over all columns, or over ``subset``."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``fillna(0)`` on model inputs."""
    return df.na.fill(0.0, subset=list(cols) if cols else None).na.fill(0, subset=list(cols) if cols else None)


def column_or(df: DataFrame, name: str, other: str | None = None, default: float | None = None):
    """The column ``name``; where the table lacks it, the column ``other``; where it lacks both, ``default`` as double."""
    found = next((c for c in (name, other) if c in df.columns), None)
    return F.col(found) if found else F.lit(default).cast("double")
