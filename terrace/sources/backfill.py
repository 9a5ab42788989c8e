"""Backfills over many periods as one job instead of a loop of small ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column


def month_blocks(df: DataFrame, first: ColumnLike, last: ColumnLike) -> DataFrame:
    """Each row's period cut into calendar months: ``block_start, block_end`` (both included)."""
    start, end = as_column(first).cast("date"), as_column(last).cast("date")
    months = F.sequence(F.trunc(start, "month"), end, F.make_ym_interval(months=F.lit(1)))
    return df.filter(start <= end).select(
        "*", F.explode(months).alias("_month")
    ).withColumns(
        {
            "block_start": F.greatest(F.col("_month"), start),
            "block_end": F.least(F.last_day("_month"), end),
        }
    ).drop("_month")


def period_table(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Month blocks of one period."""
    period = spark.range(1).select(F.lit(first).alias("_first"), F.lit(last).alias("_last"))
    return month_blocks(period, "_first", "_last").select("block_start", "block_end")


def in_months(value: ColumnLike, months: Sequence[dt.date]) -> Column:
    """Rows of any of the given months, as ranges that reach the scan as one filter.

    Neighbouring months merge into one range, so a two-year backfill is one range.
    """
    column = as_column(value)
    starts = sorted({m.replace(day=1) for m in months})
    condition = F.lit(False)
    while starts:
        low = high = starts.pop(0)
        high = _next_month(high)
        while starts and starts[0] == high:
            high = _next_month(starts.pop(0))
        condition = condition | ((column >= F.lit(low)) & (column < F.lit(high)))
    return condition


def on_days(value: ColumnLike, days: Sequence[dt.date]) -> Column:
    """Rows of any of the given days."""
    return as_column(value).cast("date").isin(*[F.lit(d) for d in sorted(set(days))])


def closed_months_before(references: Sequence[dt.date]) -> list[dt.date]:
    """The month each reference date loads: the last one that was complete by then."""
    return [(r.replace(day=1) - dt.timedelta(days=1)).replace(day=1) for r in references]


def _next_month(day: dt.date) -> dt.date:
    years, month = divmod(12 * day.year + day.month, 12)
    return dt.date(years, month + 1, 1)
