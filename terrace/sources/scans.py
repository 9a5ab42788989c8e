"""Batch and streaming scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.nested import json_elements
from terrace.sources.files import path_exists
from terrace.sources.layouts import read_layouts


class SourceMissing(Exception):
    """A file that must be published is not there."""


def read_years(spark: SparkSession, paths: Mapping[int, str], current_year: int) -> DataFrame:
    """Yearly files as one frame, columns matched by name and brought to their least common type.

    Only the file of the current year may be missing (it is published late); a gap
    in another year, or no file at all, is an error.
    """
    present = {year: path for year, path in paths.items() if path_exists(spark, path)}
    missing = sorted(set(paths) - set(present))
    if any(year != current_year for year in missing):
        raise SourceMissing(f"no file for {[y for y in missing if y != current_year]}")
    if not present:
        raise SourceMissing(f"no file for any of {sorted(paths)}")
    return read_layouts(spark, list(present.values()))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Append-only parquet folder as a stream: each run sees only new files."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def read_documents(spark: SparkSession, path: str, column: str = "document") -> DataFrame:
    """Folder of JSON documents, one row per file with its whole text and its path."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias(column), F.col("_metadata.file_path").alias("file")
    )


def responses_by_position(
    documents: DataFrame,
    document: str,
    document_id: str,
    entities: DataFrame,
    position: str,
    raw: str,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Pair the n-th response of each document with the n-th entity; one row per pair.

    A document holds a JSON list, or a single object for a single entity. A
    document whose number of responses differs from the number of entities fails
    the job: pairing by position would be wrong for all its rows. ``entities``
    carries its rank (from 0) in ``position``.
    """
    expected = entities.agg(F.count("*")).scalar()
    elements = documents.select(F.col(document_id), *shared, json_elements(document).alias("_elements"))
    mismatch = F.raise_error(
        F.concat_ws(" ", F.lit("document"), F.col(document_id).cast("string"), F.lit("holds"),
                    F.size("_elements").cast("string"), F.lit("responses, one per entity expected"))
    )
    checked = elements.withColumn(
        "_elements", F.when(F.size("_elements") == expected, F.col("_elements")).otherwise(mismatch)
    )
    rows = checked.select(document_id, *shared, F.posexplode("_elements").alias(position, raw))
    return rows.join(entities, position)
