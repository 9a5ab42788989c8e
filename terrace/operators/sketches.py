"""Quantiles and distinct counts that merge: one small state per group and part, so that an increment reads new rows only.

Exact percentiles need all values of a group again whenever some arrive. A sketch has a bounded size whatever
its rows; sketches of parts (months, say) merge to that of the whole. What a quantile of the sketch
misses is a share of the ranks, not of the value: about ``2.3 / k ** 0.9`` at 99 % confidence for one rank.
``rank_errors`` measures it. Exact percentiles stay in ``metrics.response_curve`` and ``profile``.

Distinct counts are exact. Counts of parts do not add up, as an id may occur in several; what is kept per part
is therefore its ids: as bitmaps of 32,768 neighbouring numbers (``id_bitmaps``, 4 kB each), right for dense whole
numbers, or as the different values themselves (``key_sets``), right for texts, sparse numbers and keys of several columns.

Defined results: null and NaN take no part. A group without a value has no sketch and no quantiles, no bitmap, no set
and no count. An id that occurs again, in the same part or another one, changes nothing, so a part may be read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800
SKETCH = "sketch"
BUCKET, BITMAP = "bucket", "bitmap"


def quantile_sketches(df: DataFrame, groups: Sequence[str], value: str, k: int = K) -> DataFrame:
    """One sketch per group: groups, ``sketch``."""
    usable = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return usable.groupBy(*groups).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias(SKETCH))


def merged_sketches(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches of finer groups or of parts brought together per group."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def quantiles(sketches: DataFrame, groups: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row per group and share: groups, ``share``, ``quantile``."""
    found = [F.struct(F.lit(float(p)).alias("share"), F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))).alias("quantile")) for p in shares]
    return sketches.select(*groups, F.inline(F.array(*found)))


def rank_errors(df: DataFrame, found: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``found`` with the rows of the group and by what share of them the true rank of each quantile misses its share.

    A value that occurs often has a span of ranks; within it there is no error.
    """
    usable = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = usable.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(value).cast("double").alias("_v"))
    # A group has as many rows here as shares, so the join multiplies rows by that number only.
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    met = rows.join(found, same)
    ranks = met.groupBy(*groups, "share", "quantile").agg(
        F.count("*").alias("rows"),
        (F.count_if(F.col("_v") < F.col("quantile")) / F.count("*")).alias("_below"),
        (F.count_if(F.col("_v") <= F.col("quantile")) / F.count("*")).alias("_upto"),
    )
    miss = F.greatest(F.lit(0.0), F.col("_below") - F.col("share"), F.col("share") - F.col("_upto"))
    return ranks.select(*groups, "share", "quantile", "rows", miss.alias("rank_error"))


def id_bitmaps(df: DataFrame, groups: Sequence[str], ids: str) -> DataFrame:
    """One row per group and bucket of 32,768 ids that occurs: groups, ``bucket``, ``bitmap``. Ids are whole numbers."""
    return (
        df.filter(F.col(ids).isNotNull())
        .select(*groups, F.col(ids).cast("long").alias("_id"))
        .groupBy(*groups, F.bitmap_bucket_number("_id").alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(BITMAP))
    )


def merged_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of finer groups or of parts brought together per group."""
    return bitmaps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_ids(bitmaps: DataFrame, groups: Sequence[str], name: str = "distinct") -> DataFrame:
    """The exact number of different ids per group. Both sums combine before their shuffle."""
    return merged_bitmaps(bitmaps, groups).groupBy(*groups).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))


def key_sets(df: DataFrame, groups: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The different keys of each group; a key with a null in any column takes no part. Parts merge by union."""
    return df.select(*groups, *keys).dropna(subset=list(keys)).distinct()


def distinct_keys(sets: DataFrame, groups: Sequence[str], keys: Sequence[str], name: str = "distinct") -> DataFrame:
    """The exact number of different keys per group, from the sets of finer groups or of parts."""
    return sets.select(*groups, *keys).distinct().groupBy(*groups).agg(F.count("*").alias(name))
