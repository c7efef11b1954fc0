"""Numeric helpers: tolerant casts, shares, and rounding that ignores float noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles arrive in any order, so their last bits vary from run to run.
# Rounding to this many places first keeps a value such as 12.344999999999999
# from flipping the visible digit.
NOISE_PLACES = 8

# Plain or scientific decimal numbers. Java would also accept "1d" and "0x1p3".
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def tidy(value: Column, places: int = 2) -> Column:
    """Round half up to ``places`` after settling float noise."""
    return F.round(F.round(value.cast("double"), NOISE_PLACES), places)


def percent(part: Column, whole: Column, places: int | None = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    share = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return share if places is None else tidy(share, places)


def number_or_null(text: Column, scale: int | None = None) -> Column:
    """Text to double, NULL where it is no number; ``scale`` rounds (0 = whole units)."""
    parsed = F.when(text.rlike(DECIMAL_TEXT), F.trim(text).try_cast("double"))
    return parsed if scale is None else F.round(parsed, scale)


def number_or_zero(text: Column) -> Column:
    """Text to double, 0 where it is blank or no number."""
    return F.coalesce(number_or_null(text), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
