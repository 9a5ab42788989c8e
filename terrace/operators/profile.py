"""Source profiling: keys, column statistics, duplicates, centroids, derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.columns import ColumnLike, as_column
from terrace.functions.numeric import ratio
from terrace.operators.metrics import pearson

#: Columns of a key that the search looks for; the candidates of a level grow with their binomial.
MOST_KEY_COLUMNS = 3
#: Approximate counts of 2 ** SKETCH_SIZE registers have a relative standard error of 1.6 %; twelve of them are the margin for ruling out.
SKETCH_SIZE, MARGIN = 12, 0.2


def weighted_centroid(
    df: DataFrame,
    groups: Sequence[str],
    within: Sequence[str],
    weight: str,
    coordinates: Mapping[str, ColumnLike],
    total: str,
    share: str,
) -> DataFrame:
    """Weighted mean of coordinates per group, and the group's share of the weight in ``within``.

    The totals join back on their own keys instead of a window over all groups.
    """
    centers = df.groupBy(*groups).agg(
        F.sum(weight).alias(total),
        *[
            (F.sum(as_column(value) * F.col(weight)) / F.sum(weight)).alias(name)
            for name, value in coordinates.items()
        ],
    )
    whole = centers.groupBy(*within).agg(F.sum(total).alias("_whole"))
    return centers.join(whole, list(within)).withColumn(share, ratio(total, "_whole")).drop("_whole")


def key_candidates(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Per candidate: distinct combinations, rows, and whether it is a key.

    Each candidate is counted by its own ``groupBy``, which combines copies on the
    map side and never expands a row once per candidate.
    """
    reports = []
    for columns in candidates:
        groups = df.groupBy(*columns).agg(F.count("*").alias("_n"))
        reports.append(
            groups.agg(
                F.count("*").alias("distinct_rows"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            ).select(
                F.lit(" + ".join(columns)).alias("candidate"),
                F.lit(len(columns)).alias("columns"),
                "distinct_rows",
                "rows",
                (F.col("distinct_rows") == F.col("rows")).alias("is_key"),
            )
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def smallest_key(candidate_report: DataFrame) -> DataFrame:
    """The keys with the fewest columns: one row, or several when keys of one size tie."""
    found = candidate_report.filter("is_key")
    least = found.agg(F.min("columns").alias("_least"))
    return found.join(least, F.col("columns") == F.col("_least")).drop("_least")


def natural_keys(df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = MOST_KEY_COLUMNS) -> DataFrame:
    """All keys of at most ``most_columns`` columns that hold no smaller key, searched level by level.

    A level leaves out what contains a key that was found. One scan with approximate counts
    rules out candidates far below the row count; only the others are counted exactly.
    Null is a value like any other. Every column of an empty table is a key.
    """
    names, rows = list(columns or df.columns), df.count()
    found: list[Row] = []
    keys: list[set[str]] = []
    for size in range(1, most_columns + 1):
        open_sets = [c for c in combinations(names, size) if not any(k.issubset(c) for k in keys)]
        if not open_sets:
            break
        hashed = [F.xxhash64(*[F.xxhash64(name) for name in c]) for c in open_sets]  # the inner hashes tell nulls of different columns apart
        about = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(h, SKETCH_SIZE)).alias(f"_{i}") for i, h in enumerate(hashed)]).first()
        close = [c for i, c in enumerate(open_sets) if about[i] >= (1 - MARGIN) * rows]
        for row in key_candidates(df, close).filter("is_key").collect() if close else ():
            found.append(row)
            keys.append(set(row["candidate"].split(" + ")))
    return df.sparkSession.createDataFrame(found, "candidate string, columns int, distinct_rows long, rows long, is_key boolean")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, null share, extremes and negatives of every column, in one pass."""
    names = list(columns or df.columns)
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    aggregates, records = [F.count("*").alias("_rows")], []
    for position, name in enumerate(names):
        value = F.col(name)
        negatives = F.count_if(value < 0) if name in numeric else F.lit(None).cast("long")
        aggregates += [
            F.count(value).alias(f"_c{position}"),
            F.min(value).cast("string").alias(f"_a{position}"),
            F.max(value).cast("string").alias(f"_z{position}"),
            negatives.alias(f"_g{position}"),
        ]
        nulls = F.col("_rows") - F.col(f"_c{position}")
        records.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("_rows").alias("rows"),
                nulls.alias("nulls"),
                ratio(nulls, "_rows").alias("null_share"),
                F.col(f"_a{position}").alias("lowest"),
                F.col(f"_z{position}").alias("highest"),
                F.col(f"_g{position}").alias("negatives"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*records)))


def duplicate_classes(df: DataFrame, keys: Sequence[str], values: Sequence[str], batch: str) -> DataFrame:
    """Classify keys that occur more than once.

    ``technical``    the values repeat inside one ingestion
    ``reingested``   the same values arrived in several ingestions
    ``apparent``     the values differ: a revision, or the key is not a key

    Copies first combine per (key, batch), so a key with very many copies reaches
    the second aggregation as a few rows.
    """
    print_of_values = F.struct(*values)
    per_batch = df.groupBy(*keys, batch).agg(
        F.count("*").alias("_n"), F.min(print_of_values).alias("_least"), F.max(print_of_values).alias("_most")
    )
    per_key = per_batch.groupBy(*keys).agg(
        F.sum("_n").alias("copies"),
        F.count("*").alias("batches"),
        F.min("_least").alias("_least"),
        F.max("_most").alias("_most"),
    )
    differs = ~F.col("_least").eqNullSafe(F.col("_most"))
    return per_key.filter("copies > 1").select(
        *keys,
        "copies",
        "batches",
        F.when(differs, "apparent").when(F.col("batches") > 1, "reingested").otherwise("technical").alias("class"),
    )


def derived_check(df: DataFrame, stated: ColumnLike, computed: Column, tolerance: float) -> DataFrame:
    """How many rows state a value that differs from its recomputation."""
    gap = F.abs(as_column(stated) - computed)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(gap > tolerance).alias("mismatches"),
        F.count_if(gap.isNull()).alias("not_comparable"),
        F.max(gap).alias("largest_gap"),
    )


def weekend_effect(df: DataFrame, value: str, driver: str, weekend: str) -> DataFrame:
    """Relative weekend level of ``value`` and its correlation with ``driver``."""
    return df.agg(
        F.avg(F.when(~F.col(weekend), F.col(value))).alias("weekday_mean"),
        F.avg(F.when(F.col(weekend), F.col(value))).alias("weekend_mean"),
        pearson(F.col(driver), F.col(value)).alias("correlation"),
        F.count("*").alias("days"),
    ).withColumn("weekend_change", F.try_divide("weekend_mean", "weekday_mean") - 1)
