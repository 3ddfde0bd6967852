"""Casts, ratios, means and rounding that never raise on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(column: Column | str) -> Column:
    return _col(column).try_cast("double")


def to_int(column: Column | str) -> Column:
    return _col(column).try_cast("int")


def to_boolean(column: Column | str) -> Column:
    return _col(column).try_cast("boolean")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def mean_of(column: Column | str) -> Column:
    """Mean of the values that are there, as a double; one NaN makes it NaN."""
    return F.avg(_col(column).try_cast("double"))


def total_of(column: Column | str) -> Column:
    """Sum as a double, to be combined by ``mean_of_parts``."""
    return F.sum(_col(column).try_cast("double"))


def mean_of_parts(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def half_even(column: Column | str, places: int = 2) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(_col(column), places)


def not_negative(column: Column | str) -> Column:
    return F.greatest(F.lit(0.0), _col(column))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
