"""Current values and revision history of keyed rows.

These batch functions are the definition; ``streaming.apply`` keeps the same
results up to date incrementally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.dates import minutes_between
from terrace.operators import timeline as tl

# Column names of the history layout.
START_AT = "__START_AT"
END_AT = "__END_AT"


def latest_per_key(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Current version: per key, the row with the greatest sequence.

    Rows that tie on the sequence are ordered by their columns, so the result does
    not depend on arrival order. ``row_number = 1`` makes Spark keep one row per
    key and map task before the shuffle (WindowGroupLimit), so heavy keys stay light.
    """
    rest = [c for c in df.columns if c not in (*keys, sequence)]
    newest = Window.partitionBy(*keys).orderBy(F.desc(sequence), *[F.desc(c) for c in rest])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def change_history(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    long_key_rows: int = tl.LONG_KEY_ROWS,
    number: str | None = None,
) -> DataFrame:
    """One row per version: a version starts when a tracked column changes.

    Re-reads with equal tracked values only advance the sequence column. The other
    columns come from the last row of the version; ``__END_AT`` is null on the
    version in force. A value that returns after another one is a new version.
    ``number`` names an optional column with the order of the version in its key.
    """
    steps = tl.timeline(df, keys, sequence, tracked, long_key_rows=long_key_rows)
    return steps.filter(tl.RUN_ENDS).select(
        *df.columns,
        F.col(tl.RUN_START).alias(START_AT),
        F.col(tl.NEXT_AT).alias(END_AT),
        *([F.col(tl.RUN).cast("int").alias(number)] if number else []),
    )


def readable_versions(
    history: DataFrame,
    keys: Sequence[str],
    sequence: str,
    names: Sequence[str],
    long_key_rows: int = tl.LONG_KEY_ROWS,
) -> DataFrame:
    """History with business names for the technical columns.

    ``names``: output names of version number, valid from, valid to, is current,
    confirmed at.
    """
    placed = tl.timeline(history, keys, START_AT, long_key_rows=long_key_rows)
    numbered = placed.select(*history.columns, F.col(tl.POSITION).cast("int").alias("_number"))
    return with_business_names(numbered, "_number", sequence, names)


def with_business_names(numbered: DataFrame, position: str, sequence: str, names: Sequence[str]) -> DataFrame:
    """Numbered history as readable versions: a projection, no shuffle."""
    number, since, until, current, confirmed = names
    data = [c for c in numbered.columns if c not in (START_AT, END_AT, sequence, position)]
    return numbered.select(
        *data,
        F.col(position).alias(number),
        F.col(START_AT).alias(since),
        F.col(END_AT).alias(until),
        F.col(END_AT).isNull().alias(current),
        F.col(sequence).alias(confirmed),
    )


def revisions(
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    long_key_rows: int = tl.LONG_KEY_ROWS,
) -> DataFrame:
    """One row per revision: old and new value, the change, and its delay in days."""
    placed = tl.timeline(history, keys, START_AT, [value], long_key_rows=long_key_rows)
    before = F.col(tl.PREVIOUS)
    return placed.filter(before.isNotNull()).select(
        *keys,
        F.col(START_AT).alias("revised_at"),
        before[value].alias("old_value"),
        F.col(value).alias("new_value"),
        (F.col(value) - before[value]).alias("change"),
        (minutes_between(before["at"], F.col(START_AT)) / (24 * 60)).alias("delay_days"),
    )


def revision_summary(revised: DataFrame, groups: Sequence[str]) -> DataFrame:
    """How often and by how much values were revised, per group."""
    return revised.groupBy(*groups).agg(
        F.count("*").alias("revisions"),
        F.avg("change").alias("mean_change"),
        F.avg(F.abs("change")).alias("mean_absolute_change"),
        F.max("delay_days").alias("longest_delay_days"),
    )
