"""Rounding and shares. ``round`` is half-up throughout."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_mean(col: Column, digits: int | None) -> Column:
    """Mean of a column, rounded unless ``digits`` is None."""
    return F.avg(col) if digits is None else F.round(F.avg(col), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``100 * part / whole`` rounded; null when the whole is 0."""
    return F.round(F.try_divide(100.0 * part, whole), digits)


def mean_of(total: Column, n: Column, digits: int) -> Column:
    """Rounded mean from a sum and a count; null for a count of 0."""
    return F.round(F.try_divide(total, n), digits)
