"""Numeric expressions: safe ratios, flag agreement, masked assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_ratio(num: Column, den: Column, scale: float | None = None, digits: int | None = None) -> Column:
    """``num / den`` where a zero, missing or non-finite result becomes 0.

    Computed in double (``try_divide`` so ANSI mode never raises on /0), then
    optionally multiplied by ``scale`` and rounded to ``digits``.
    """
    q = F.try_divide(num.cast("double"), den.cast("double"))
    if scale is not None:
        q = q * F.lit(float(scale))
    finite = q.isNotNull() & ~F.isnan(q) & (F.abs(q) != F.lit(float("inf")))
    q = F.when(finite, q).otherwise(F.lit(0.0))
    return F.round(q, digits) if digits is not None else q


def flags_agree(a: Column, b: Column) -> Column:
    """Both 0 or both 1 (``a + b != 1``); a missing flag drops the row."""
    return (a + b) != F.lit(1)


def role_gate(value: Column, role: Column, wanted: str, otherwise=0) -> Column:
    """Masked assignment: ``value`` where ``role == wanted`` else ``otherwise``."""
    return F.when(role == F.lit(wanted), value).otherwise(F.lit(otherwise))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def fill_numeric_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing -> 0 on numeric columns only; text keys stay missing."""
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, _NUMERIC) and (columns is None or f.name in columns)]
    return df.select(*[
        (F.coalesce(F.col(f"`{f.name}`"), F.lit(0).cast(f.dataType)).alias(f.name) if f.name in names
         else F.col(f"`{f.name}`"))
        for f in df.schema.fields])
