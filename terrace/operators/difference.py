"""Where two tables differ, found from hashes per key bucket.

Each side is summed up per bucket of its key's hash: rows, and sums of two row hashes, which do not
depend on the order of rows. Only buckets whose sums differ are read again; there, rows
meet by key and hash in one aggregation, not in a join, so null keys and repeated
rows need no care. Tables kept with ``write_buckets`` have their buckets as folders, and the second
reading opens only the folders that differ.

Defined results: rows are compared as bags. A key is ``missing`` if only the left side has it,
``added`` if only the right side has, else ``changed`` if its rows or how often they occur
differ. Null is a value. Both sides must have the same columns (in any order); a different
row escapes with a chance of 2^-128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 64
BUCKET = "key_bucket"


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row; what is null counts, as the hash function passes over nulls."""
    told = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return [F.xxhash64(*told), F.xxhash64(F.lit(1), *told)]


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write a table with a folder per key bucket, for comparisons that read only some."""
    rows = df.withColumn(BUCKET, key_bucket(keys, buckets))
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df if BUCKET in df.columns else df.withColumn(BUCKET, key_bucket(keys, buckets))


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket: rows, and the sums of both row hashes."""
    one, other = (h.cast("decimal(38,0)") for h in _row_hashes(columns))
    return _bucketed(df, keys, buckets).groupBy(BUCKET).agg(F.count("*").alias("rows"), F.sum(one).alias("digest"), F.sum(other).alias("second_digest"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Numbers of the buckets whose rows differ: at most ``buckets`` of them reach the driver."""
    columns = sorted(c for c in left.columns if c != BUCKET)
    if columns != sorted(c for c in right.columns if c != BUCKET):
        raise ValueError(f"the tables have different columns: {left.columns} and {right.columns}")
    sides = bucket_digests(left, keys, columns, buckets).unionByName(bucket_digests(right, keys, columns, buckets))
    # Equal digests of both sides fall together and count two.
    alone = sides.groupBy(*sides.columns).agg(F.count("*").alias("sides")).filter("sides = 1")
    return sorted({row[BUCKET] for row in alone.select(BUCKET).collect()})


def table_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per key that differs: the key, ``difference``, and how many rows each side has for it.

    Both sides must be cut into the same number of buckets if they were kept with ``write_buckets``.
    """
    found = differing_buckets(left, right, keys, buckets)
    columns = sorted(c for c in left.columns if c != BUCKET)

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        rows = _bucketed(df, keys, buckets).filter(F.col(BUCKET).isin(found))
        one, other = _row_hashes(columns)
        return rows.select(*keys, one.alias("_one"), other.alias("_other"), F.lit(int(is_left)).alias("_left"), F.lit(int(not is_left)).alias("_right"))

    rows = side(left, True).unionByName(side(right, False))
    same = rows.groupBy(*keys, "_one", "_other").agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    per_key = same.groupBy(*keys).agg(
        F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows"), F.max(F.col("_left") != F.col("_right")).alias("_differs")
    )
    kind = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "added").otherwise("changed")
    return per_key.filter("_differs").select(*keys, kind.alias("difference"), "left_rows", "right_rows")
