"""Numeric column helpers that keep missing values missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(col: Column) -> Column:
    """Number from text; what does not parse, and NaN, is missing."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def clip(col: Column, low: float | None, high: float | None) -> Column:
    """Clip to [low, high]. Spark's greatest/least skip nulls, so guard them."""
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return out if out is col else F.when(col.isNotNull(), out)


def half_up(col: Column, places: int) -> Column:
    """Round half up on the binary value; the same in every engine."""
    scale = float(10**places)
    return F.floor(col * scale + 0.5) / scale


def non_negative(col: Column) -> Column:
    """Clamp at zero; NaN counts as zero, null stays null."""
    return F.when(F.isnan(col) | (col < 0), F.lit(0.0)).otherwise(col)
