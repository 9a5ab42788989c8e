"""Parametrized business metrics: ratios of sums, shortfall, errors, curves, correlations.

All of them are one ``groupBy`` whose aggregates combine on the map side, so a
group that holds a large part of the rows costs one small buffer per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column
from terrace.functions.numeric import absolute_error, bin_start, ratio


def named(columns: Mapping[str, ColumnLike]) -> list[Column]:
    return [as_column(value).alias(name) for name, value in columns.items()]


def ratio_of_sums(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Weighted ratio, null over a zero sum; each sum skips its own nulls."""
    return F.try_divide(F.sum(as_column(numerator)), F.sum(as_column(denominator)))


def grouped_sums(
    df: DataFrame,
    groups: Mapping[str, ColumnLike],
    sums: Mapping[str, ColumnLike],
    *,
    scale: float = 1.0,
    distinct: Mapping[str, ColumnLike] | None = None,
    others: Mapping[str, Column] | None = None,
    ratios: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Grouped sums with exact distinct counts, further aggregates and guarded ratios of the sums.

    ``scale`` turns summed slot power into energy (0.5 for half hours). For a text
    that labels each group see ``labelled_sums``.
    """
    aggregates = [F.count_distinct(as_column(c)).alias(name) for name, c in (distinct or {}).items()]
    for name, value in sums.items():
        total = F.sum(as_column(value))
        aggregates.append((total if scale == 1.0 else total * scale).alias(name))
    aggregates += [value.alias(name) for name, value in (others or {}).items()]
    totals = df.groupBy(*named(groups)).agg(*aggregates)
    quotients = {name: ratio(top, bottom) for name, (top, bottom) in (ratios or {}).items()}
    return totals.withColumns(quotients) if quotients else totals


def labelled_sums(
    df: DataFrame,
    groups: Mapping[str, ColumnLike],
    label: tuple[str, ColumnLike],
    sums: Mapping[str, ColumnLike],
    *,
    scale: float = 1.0,
    ratios: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Grouped sums with the greatest of each group's labels.

    The maximum of a text cannot be kept in a hash aggregate, so taking it over the
    rows would sort them all. The rows are summed per group and label first, by
    hash; only these few sums are sorted for the label.
    """
    name, value = label
    per_label = grouped_sums(df, {**groups, name: value}, sums, scale=scale)
    return grouped_sums(
        per_label, {g: g for g in groups}, {s: s for s in sums}, others={name: F.max(name)}, ratios=ratios
    )


def response_curve(
    df: DataFrame,
    groups: Sequence[str],
    value: Column,
    width: Column,
    numerator: str,
    denominator: str,
    rate: str,
    names: Sequence[str],
    percentiles: Sequence[float] = (0.25, 0.75),
) -> DataFrame:
    """Weighted rate per equal-width bin of ``value``, with the spread of the hourly rate.

    ``names``: output names of bin start, bin end, row count, weighted rate and of
    each percentile.
    """
    low, high, rows, weighted, *spread = names
    binned = df.withColumns({"_value": value, "_width": width}).filter(
        F.col("_value").isNotNull() & F.col(rate).isNotNull()
    )
    return (
        binned.withColumn(low, bin_start("_value", F.col("_width")))
        .withColumn(high, F.col(low) + F.col("_width"))
        .groupBy(*groups, low, high)
        .agg(
            F.count("*").alias(rows),
            ratio_of_sums(numerator, denominator).alias(weighted),
            *[F.percentile_approx(rate, share).alias(name) for share, name in zip(percentiles, spread, strict=True)],
        )
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs, null when one side is constant.

    Comparing extremes is exact; a standard deviation of a constant may come out
    slightly above zero and give a meaningless quotient.
    """
    left, right = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    varies = (F.min(left) < F.max(left)) & (F.min(right) < F.max(right))
    spread = F.stddev_samp(left) * F.stddev_samp(right)
    return F.when(varies, F.try_divide(F.covar_samp(left, right), spread))


def correlations(
    df: DataFrame,
    groups: Sequence[str],
    pairs: Sequence[tuple[Column, str]],
    target: str,
    names: Sequence[str],
) -> DataFrame:
    """Correlation of several variables with ``target`` per group, in a single pass.

    ``pairs``: (condition that selects the rows of this pair, variable). A group
    without any row for a pair gives no row. ``names``: output names of variable,
    correlation and row count.
    """
    variable, strength, rows = names
    aggregates, records = [], []
    for position, (applies, name) in enumerate(pairs):
        x, y = F.when(applies, F.col(name)), F.when(applies, F.col(target))
        aggregates += [pearson(x, y).alias(f"_r{position}"), F.count_if(applies).alias(f"_n{position}")]
        records.append(
            F.struct(
                F.lit(name).alias(variable),
                F.col(f"_r{position}").alias(strength),
                F.col(f"_n{position}").alias(rows),
            )
        )
    return (
        df.groupBy(*groups)
        .agg(*aggregates)
        .select(*groups, F.inline(F.array(*records)))
        .filter(F.col(rows) > 0)
    )


def mean_errors(predicted: Column, observed: Column) -> tuple[Column, Column]:
    """(mean absolute error, mean signed error) as aggregates."""
    return F.avg(absolute_error(predicted, observed)), F.avg(predicted - observed)


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join; rows without a partner drop out (see ``match_report``).

    No hints: the sides are aggregated or pruned by the caller, adaptive execution
    broadcasts a side it has measured to be small and splits skewed partitions.
    """
    return left.join(right, list(keys), "inner")


def match_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts behind ``matched``: joined, and unmatched on either side, in one row."""
    a = left.groupBy(*keys).agg(F.count("*").alias("_left"))
    b = right.groupBy(*keys).agg(F.count("*").alias("_right"))
    both = a.join(b, list(keys), "full")
    return both.agg(
        F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum(F.when(F.col("_right").isNull(), F.col("_left"))), F.lit(0)).alias("left_unmatched"),
        F.coalesce(F.sum(F.when(F.col("_left").isNull(), F.col("_right"))), F.lit(0)).alias("right_unmatched"),
    )
