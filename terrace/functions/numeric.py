"""Guarded arithmetic and binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, null unless the denominator is positive."""
    below = as_column(denominator)
    return F.when(below > 0, as_column(numerator) / below)


def relative_change(value: ColumnLike, base: ColumnLike) -> Column:
    """(value - base) / base, null unless the base is positive."""
    return ratio(as_column(value) - as_column(base), base)


def shortfall(expected: ColumnLike, planned: ColumnLike) -> Column:
    """Positive part of ``expected - planned``.

    ``greatest`` skips nulls, so a row with a missing side counts as zero
    shortfall while its other side still enters the sums.
    """
    return F.greatest(as_column(expected) - as_column(planned), F.lit(0.0))


def exceeds(value: ColumnLike, tolerance: float) -> Column:
    """1 when strictly above the tolerance, 0 otherwise, null for null."""
    return (as_column(value) > tolerance).cast("int")


def absolute_error(left: ColumnLike, right: ColumnLike) -> Column:
    return F.abs(as_column(left) - as_column(right))


def bin_start(value: ColumnLike, width: ColumnLike | float) -> Column:
    """Lower edge of the equal-width bin ``[edge, edge + width)`` as DOUBLE."""
    step = F.lit(float(width)) if isinstance(width, (int, float)) else as_column(width)
    return F.floor(as_column(value) / step) * step


def only_if(condition: Column, value: ColumnLike) -> Column:
    """The value where the condition holds, else null (left out of aggregates)."""
    return F.when(condition, as_column(value))


def flag(value: ColumnLike) -> Column:
    """Numeric 0/1 to boolean; null stays null."""
    return as_column(value) == 1
