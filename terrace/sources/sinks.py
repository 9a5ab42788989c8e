"""Append-only raw tables, published snapshots, exports and clones."""

from __future__ import annotations

import uuid
import datetime as dt
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.align import align_to_schema
from terrace.sources.files import list_names, path_exists, publish_small, read_small

# Metadata columns of raw tables.
INGESTED_AT = "ingestion_timestamp"
SOURCE = "source"


def raw_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a raw table, None before its first append.

    Appends keep it in a small file, so neither a reader nor the next append has to
    merge the footers of all data files. Tables written otherwise are merged once.
    """
    kept = [n for n in list_names(spark, f"{path}/_schema") if not n.endswith(".tmp")]
    if kept:
        return T.StructType.fromJson(json.loads(read_small(spark, f"{path}/_schema/{kept[-1]}")))
    if not path_exists(spark, path):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw table with the union of the columns its files ever had."""
    schema = raw_schema(spark, path.rstrip("/"))
    if schema is None:
        raise FileNotFoundError(path)
    return spark.read.schema(schema).parquet(path)


def _keep_schema(spark: SparkSession, path: str, known: T.StructType | None, arriving: T.StructType) -> None:
    """Record new columns before their data is written; existing ones keep type and place."""
    fields = list(known.fields) if known else []
    present = {f.name for f in fields}
    added = [f for f in arriving if f.name not in present]
    versions = [n for n in list_names(spark, f"{path}/_schema") if not n.endswith(".tmp")]
    if added or not versions:
        text = T.StructType([*fields, *added]).json()
        publish_small(spark, f"{path}/_schema/{len(versions):06d}", text)


def append_raw(
    df: DataFrame,
    path: str,
    source: str,
    ingested_at: dt.datetime,
    partition_by: Sequence[str] = (),
) -> int:
    """Append rows with ingestion metadata and return how many were written.

    Types follow the table (``align_to_schema``), new columns are accepted. The
    count is observed by the write itself, so the source is not read again.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    known = raw_schema(spark, path)
    if known is not None:
        df = align_to_schema(df, known)
    written = Observation()
    stamped = df.withColumns({INGESTED_AT: F.lit(ingested_at), SOURCE: F.lit(source)})
    _keep_schema(spark, path, known, stamped.schema)
    stamped.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(*partition_by).parquet(path)
    return int(written.get["rows"])


class Snapshot:
    """Fully recomputed table: each refresh is a new folder, then one pointer names it.

    Readers keep the folder they resolved while a refresh runs, and a failed
    refresh leaves the published one in place.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _pointers(self, spark: SparkSession) -> list[str]:
        return [n for n in list_names(spark, f"{self.root}/_published") if not n.endswith(".tmp")]

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._pointers(spark))

    def live_path(self, spark: SparkSession) -> str:
        pointers = self._pointers(spark)
        if not pointers:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return f"{self.root}/{read_small(spark, f'{self.root}/_published/{pointers[-1]}')}"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.live_path(spark))

    def refresh(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        spark = df.sparkSession
        pointers = self._pointers(spark)
        version = int(pointers[-1]) + 1 if pointers else 0
        folder = f"v={version:012d}-{uuid.uuid4().hex[:12]}"  # never used before: a refresh that fails leaves no trace in another's rows
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        publish_small(spark, f"{self.root}/_published/{version:012d}", folder)
        return self.read(spark)


class MonthlySnapshot:
    """Published table whose rows belong to months: a refresh writes some months, the others stay as they are.

    One small file names the folder in force for each month, and what the months were computed from.
    """

    PART = "month_part"

    def __init__(self, root: str, month_column: str):
        self.root, self.month_column = root.rstrip("/"), month_column

    def _published(self, spark: SparkSession) -> tuple[int, dict]:
        names = [n for n in list_names(spark, f"{self.root}/_published") if not n.endswith(".tmp")]
        return (int(names[-1]), json.loads(read_small(spark, f"{self.root}/_published/{names[-1]}"))) if names else (-1, {})

    def seen(self, spark: SparkSession) -> dict | None:
        """What the last refresh was given, None before the first."""
        return self._published(spark)[1].get("seen")

    def read(self, spark: SparkSession) -> DataFrame:
        number, told = self._published(spark)
        if number < 0:
            raise FileNotFoundError(f"nothing published under {self.root}")
        schema = T.StructType.fromJson(told["schema"])
        paths = [f"{self.root}/{folder}/{self.PART}={month}" for month, folder in told["folders"].items()]
        if not paths:
            return spark.createDataFrame([], schema)
        # The folders are chosen by name, so no partition columns are inferred.
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def refresh(self, df: DataFrame, months: Sequence[str], seen: dict) -> DataFrame:
        """Replace the rows of ``months`` by those of ``df``; a month without rows is gone."""
        spark = df.sparkSession
        number, told = self._published(spark)
        folder = f"v={number + 1:012d}-{uuid.uuid4().hex[:12]}"
        month = F.coalesce(F.trunc(F.col(self.month_column), "month").cast("string"), F.lit("none"))
        rows = df.withColumn(self.PART, month).filter(F.col(self.PART).isin(list(months)))
        rows.hint("rebalance", self.PART).write.partitionBy(self.PART).parquet(f"{self.root}/{folder}")
        folders = {m: f for m, f in told.get("folders", {}).items() if m not in months}
        written = [n for n in list_names(spark, f"{self.root}/{folder}") if n.startswith(f"{self.PART}=")]
        folders |= {n.split("=", 1)[1]: folder for n in written}
        text = json.dumps({"folders": folders, "schema": df.schema.jsonValue(), "seen": seen})
        publish_small(spark, f"{self.root}/_published/{number + 1:012d}", text)
        return self.read(spark)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def clone_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a table once; an existing target is left alone. True if it copied."""
    if path_exists(spark, f"{target.rstrip('/')}/_SUCCESS"):
        return False
    read_raw(spark, source).write.mode("overwrite").parquet(target)
    return True


def reconcile_counts(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and target per table, in one distributed query."""
    sides = []
    for name, (source, target) in tables.items():
        for frame, in_source in ((source, True), (target, False)):
            sides.append(
                frame.select(F.lit(name).alias("table"), F.lit(in_source).alias("_in_source"))
            )
    rows = reduce(DataFrame.unionByName, sides)
    counts = rows.groupBy("table").agg(
        F.count_if("_in_source").alias("source_rows"), F.count_if(~F.col("_in_source")).alias("target_rows")
    )
    return counts.withColumn("equal", F.col("source_rows") == F.col("target_rows"))
