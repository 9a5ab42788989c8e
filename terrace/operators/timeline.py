"""Neighbour rows along each key's timeline, safe for keys of any size.

A window per key sends all rows of the key to one task. That is right for
ordinary keys and wrong for a key that holds a large part of the table, so keys
above ``long_key_rows`` take another way: their timeline is cut into slices at
order values drawn by hash, each slice is walked on its own, and one summary
row per slice carries the state across the cuts. Both ways give the same rows.

The cuts are order values themselves, so any type that sorts is cut alike, and a hash
of key and order value draws them, so a second reading of the rows draws the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG_KEY_ROWS = 2_000_000
SLICE_ROWS = 65_536
# Order values drawn per slice, of which one is a cut: slices then differ little in size. Fewer are drawn per slice
# where a key would have more than MOST_DRAWN of them.
PER_SLICE = 64
MOST_DRAWN = 1_048_576
# Cuts of all long keys together, which bounds what is broadcast; beyond it slices grow.
MOST_CUTS = 1_048_576
MOST_CUTS_PER_KEY = 65_536
# Sampled rows that tell a long key: a key near the limit may take either way, with the same rows.
TELLING_ROWS = 1_024
# Long keys number at most rows / LONG_KEY_ROWS; below this many they are broadcast,
# beyond it the split is an ordinary shuffle join.
BROADCAST_LONG_KEYS = 1_000

RUN, RUN_START, NEXT_AT, RUN_ENDS, POSITION, PREVIOUS = (
    "_run", "_run_start", "_next_at", "_run_ends", "_position", "_previous",
)
_SLICE = "_slice"


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match; keeps only the left columns for semi and anti."""
    renamed = right.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    condition = reduce(
        Column.__and__, (_same(left[k], renamed[f"_k{i}"]) for i, k in enumerate(keys))
    )
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def _long_keys(df: DataFrame, keys: Sequence[str], long_key_rows: int) -> tuple[DataFrame, int] | None:
    """(keys above the limit with their ``_rows``, how many at most), or None if there are none.

    A sample of the key columns decides, so only that share of the rows is counted and shuffled. Up to
    ``BROADCAST_LONG_KEYS`` keys are told to the driver and broadcast back. If there are more, keys are counted
    exactly: a plan that is read more than once has to name the same keys each time, which a sample need not.
    """
    share = min(1.0, TELLING_ROWS / max(1, long_key_rows))
    sampled = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, 42)
    count = lambda rows: rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    above = F.col("_rows") > long_key_rows
    counted = count(sampled).withColumn("_rows", F.ceil(F.col("_rows") / F.lit(share))).filter(above)
    found = counted.limit(BROADCAST_LONG_KEYS + 1).collect()
    if not found:
        return None
    if len(found) <= BROADCAST_LONG_KEYS:
        return F.broadcast(df.sparkSession.createDataFrame(found, counted.schema)), len(found)
    return count(df).filter(above), len(found)


def _cuts(matched: DataFrame, keys: Sequence[str], order: str, most: int) -> DataFrame:
    """Per long key the sorted order values at which its slices begin.

    ``_rows / _target`` slices are wanted. Equal order values are drawn together and count once, as they collapse to
    one row, so copies neither move a cut nor make a slice of their own.
    """
    target = F.greatest(F.lit(SLICE_ROWS), F.ceil(F.col("_rows") / F.lit(most)))
    every = F.greatest(F.lit(1), F.floor(target / F.lit(PER_SLICE)), F.ceil(F.col("_rows") / F.lit(MOST_DRAWN)))
    drawn = matched.filter(F.col(order).isNotNull() & (F.pmod(F.xxhash64(*keys, order), every) == 0))
    stride = F.floor(target / every)
    drawn = drawn.select(*keys, F.col(order).alias("_at"), stride.cast("int").alias("_stride")).distinct()
    values = drawn.groupBy(*keys).agg(F.sort_array(F.collect_set("_at")).alias("_drawn"), F.max("_stride").alias("_stride"))
    return values.select(*keys, F.filter("_drawn", lambda _, i: (i + 1) % F.col("_stride") == 0).alias("_cuts"))


def _slice_of(order: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are not above the value, by halving steps; 0 for null and where there are no cuts."""
    steps = F.array(*[F.lit(2**i) for i in range(MOST_CUTS_PER_KEY.bit_length(), -1, -1)])
    reached = lambda place: F.coalesce(F.get(cuts, place - 1) <= order, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda place, step: F.when(reached(place + step), place + step).otherwise(place))


def split_long_keys(
    df: DataFrame, keys: Sequence[str], order: str, long_key_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of long keys with their slice); second part None if there are none."""
    told = _long_keys(df, keys, long_key_rows)
    if told is None:
        return df, None
    long_keys, number = told
    few = number <= BROADCAST_LONG_KEYS
    ordinary = _on_keys(df, long_keys, keys, "left_anti")
    matched = _on_keys(df, long_keys, keys, "inner")
    cuts = _cuts(matched, keys, order, min(MOST_CUTS_PER_KEY, max(1, MOST_CUTS // number)))
    placed = _on_keys(matched, F.broadcast(cuts) if few else cuts, keys, "left")
    long_rows = placed.withColumn(_SLICE, _slice_of(F.col(order), F.col("_cuts")))
    return ordinary, long_rows.drop("_rows", "_cuts")


def last_per_instant(df: DataFrame, groups: Sequence[str], order: str, ties: Sequence[str]) -> DataFrame:
    """One row per (group, order value): the greatest by the ``ties`` columns.

    The window shares its partitioning and sort order with the walk that follows,
    so it adds no shuffle.
    """
    walk = Window.partitionBy(*groups).orderBy(order, *ties)
    # The struct tells a missing next row from a next row whose order value is null.
    following = F.lead(F.struct(F.col(order).alias("at"))).over(walk)
    return (
        df.withColumn("_following", following)
        .filter(F.col("_following").isNull() | ~_same(F.col("_following.at"), F.col(order)))
        .drop("_following")
    )


def _collapse_before_shuffle(df: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Same result as ``last_per_instant`` by aggregation, which combines on the map side.

    Used for long keys, where one instant may itself hold very many copies.
    """
    rest = [c for c in df.columns if c not in (*groups, order)]
    if not rest:
        return df.distinct()
    latest = F.max(F.struct(*rest)).alias("_latest")
    return df.groupBy(*groups, order).agg(latest).select(*groups, order, "_latest.*").select(*df.columns)


def _walk(df: DataFrame, groups: Sequence[str], order: str, tracked: Sequence[str]) -> DataFrame:
    """Neighbours and running state inside each group.

    ``_changed`` is null on the first row of a group: only the caller knows what
    came before it.
    """
    along = Window.partitionBy(*groups).orderBy(order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = F.struct(F.col(order).alias("at"), *tracked)
    stepped = df.withColumn(PREVIOUS, F.lag(now).over(along)).withColumn("_following", F.lead(now).over(along))
    differs = [~_same(F.col(f"{PREVIOUS}.{c}"), F.col(c)) for c in tracked]
    changed = reduce(Column.__or__, differs, F.lit(False)) if tracked else F.lit(True)
    ends = [~_same(F.col(f"_following.{c}"), F.col(c)) for c in tracked]
    ended = reduce(Column.__or__, ends, F.lit(False)) if tracked else F.lit(True)
    return (
        stepped.withColumn("_changed", F.when(F.col(PREVIOUS).isNotNull(), changed))
        .withColumn("_ended", F.when(F.col("_following").isNotNull(), ended))
        .withColumn("_changes", F.sum(F.coalesce(F.col("_changed").cast("long"), F.lit(0))).over(so_far))
        .withColumn("_changed_at", F.max(F.when(F.col("_changed"), F.col(order))).over(so_far))
        .withColumn(POSITION, F.row_number().over(along).cast("long"))
    )


def _finish_whole(walked: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """Ordinary keys: the group is the whole timeline, so the first row starts run 1."""
    along = Window.partitionBy(*keys).orderBy(order)
    start = F.first(F.col(order)).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        walked.withColumn(RUN, F.col("_changes") + 1)
        .withColumn(RUN_START, F.coalesce("_changed_at", start))
        .withColumn(NEXT_AT, F.col("_following.at"))
        .withColumn(RUN_ENDS, F.coalesce("_ended", F.lit(True)))
    )


def _finish_sliced(walked: DataFrame, keys: Sequence[str], order: str, tracked: Sequence[str]) -> DataFrame:
    """Long keys: bring the state of the earlier slices and the head of the next one to every row.

    The summary has one row per slice, about rows / SLICE_ROWS per key, so its
    window per key stays small.
    """
    now = F.struct(F.col(order).alias("at"), *tracked)
    summary = walked.groupBy(*keys, _SLICE).agg(
        F.min(now).alias("_first"),
        F.max(now).alias("_last"),
        F.max("_changes").alias("_inner"),
        F.max("_changed_at").alias("_inner_at"),
        F.count("*").alias("_size"),
    )
    along = Window.partitionBy(*keys).orderBy(_SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before")
    differs = [~_same(before[c], F.col("_first")[c]) for c in tracked]
    opens = before.isNull() | (reduce(Column.__or__, differs, F.lit(False)) if tracked else F.lit(True))
    carried = (
        summary.withColumn("_before", F.lag("_last").over(along))
        .withColumn("_after", F.lead("_first").over(along))
        .withColumn("_opens", opens)
        .withColumn("_inner_at", F.coalesce("_inner_at", F.when(F.col("_opens"), F.col("_first.at"))))
        .withColumn("_runs_before", F.coalesce(F.sum(F.col("_inner") + F.col("_opens").cast("long")).over(earlier), F.lit(0)))
        .withColumn("_start_before", F.max("_inner_at").over(earlier))
        .withColumn("_rows_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(*keys, _SLICE, "_before", "_after", "_opens", "_first", "_runs_before", "_start_before", "_rows_before")
    )
    rows = _on_keys(walked, carried, [*keys, _SLICE], "inner")
    after_differs = [~_same(F.col("_after")[c], F.col(c)) for c in tracked]
    ended = reduce(Column.__or__, after_differs, F.lit(False)) if tracked else F.lit(True)
    return (
        rows.withColumn(RUN, F.col("_runs_before") + F.col("_opens").cast("long") + F.col("_changes"))
        .withColumn(
            RUN_START,
            F.coalesce("_changed_at", F.when(F.col("_opens"), F.col("_first.at")).otherwise(F.col("_start_before"))),
        )
        .withColumn(NEXT_AT, F.coalesce(F.col("_following.at"), F.col("_after.at")))
        .withColumn(RUN_ENDS, F.coalesce("_ended", F.col("_after").isNull() | ended))
        .withColumn(POSITION, F.col("_rows_before") + F.col(POSITION))
        .withColumn(PREVIOUS, F.coalesce(PREVIOUS, "_before"))
    )


def timeline(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tracked: Sequence[str] = (),
    ties: Sequence[str] | None = None,
    long_key_rows: int = LONG_KEY_ROWS,
) -> DataFrame:
    """Every row with its place on the timeline of its key.

    Rows with equal ``order`` collapse to one, the greatest by ``ties`` (by default
    all other columns in their order). Adds

    ``_position``   row number along the key, from 1
    ``_previous``   struct of ``at`` and the tracked columns of the row before
    ``_run``        number of the run of equal tracked values, from 1
    ``_run_start``  order value at which the run began
    ``_run_ends``   true on the last row of a run
    ``_next_at``    order value of the following row, null on the last row

    With no tracked columns every row is a run of its own.
    """
    keys, tracked = list(keys), list(tracked)
    names = list(df.columns)
    if ties is None:
        ties = [c for c in names if c not in (*keys, order)]
    output = [*names, POSITION, PREVIOUS, RUN, RUN_START, RUN_ENDS, NEXT_AT]
    ordinary, long_rows = split_long_keys(df, keys, order, long_key_rows)
    result = _finish_whole(
        _walk(last_per_instant(ordinary, keys, order, ties), keys, order, tracked), order, keys
    ).select(*output)
    if long_rows is None:
        return result
    ordered = long_rows.select(*keys, _SLICE, order, *ties, *[c for c in names if c not in (*keys, order, *ties)])
    groups = [*keys, _SLICE]
    walked = _walk(_collapse_before_shuffle(ordered, groups, order), groups, order, tracked)
    return result.unionByName(_finish_sliced(walked, keys, order, tracked).select(*output))
