"""Tolerant number handling: dirty text in, null instead of failure or NaN out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_statistic(value: Column) -> Column:
    """Statistics text to double. '-', '...' and anything that is no number become null; ',' is the decimal mark."""
    dotted = F.replace(value, F.lit(","), F.lit("."))
    # Java's parser would take '1d' or '0x1p3' for a number; the pattern keeps those out.
    return F.when(dotted.rlike(_PLAIN_NUMBER), dotted.try_cast("double"))


def null_if_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply at every source boundary: a NaN measure is a missing measure."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: null_if_nan(F.col(name)) for name in floating})


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; null when the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)
