"""Ingestion runs: published files and captured responses to append-only raw tables.

``landing`` is a folder with the published files under their own names. Weather
responses lie below ``landing/<feed>`` as JSON documents in ``column=value``
folders that carry the columns common to all points of a document.

Every run takes the periods it loads as a collection, so a backfill over many
months is one scan and one append instead of a loop of small jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import dates
from terrace.plans.energy import values as v
from terrace.sources import audit, backfill, scans, sinks
from terrace.sources.align import align_to_schema

AUDIT_TABLE = "controle._audit_log"


def raw_path(raw_root: str, table: str) -> str:
    return f"{raw_root.rstrip('/')}/{table.replace('.', '/')}"


def audit_path(raw_root: str) -> str:
    return raw_path(raw_root, AUDIT_TABLE)


def _append(spark: SparkSession, feed: str, raw_root: str, reference: dt.date, read) -> int:
    pipeline, source, table, _ = v.FEEDS[feed]
    with audit.audited_run(spark, audit_path(raw_root), pipeline, reference) as run:
        rows = align_to_schema(read(), _layout(feed))
        run.rows = sinks.append_raw(rows, raw_path(raw_root, table), source, run.started_at)
    return run.rows


def _published(landing: str, feed: str, periods: Iterable[dt.date]) -> list[str]:
    pattern = v.FEEDS[feed][3]
    return [f"{landing.rstrip('/')}/{pattern.format(period)}" for period in sorted(set(periods))]


def _layout(feed: str) -> T.StructType:
    """Types that a feed's raw table is declared with, whatever the first file happens to hold."""
    return T.StructType.fromDDL(v.RAW_LAYOUTS[v.FEEDS[feed][2]])


def _read_files(spark: SparkSession, feed: str, paths: Sequence[str]) -> DataFrame:
    """The files as one frame: files of one schema are one scan, each aligned to the declared layout."""
    same: dict[str, list[str]] = {}
    for path in paths:
        same.setdefault(spark.read.parquet(path).schema.json(), []).append(path)  # footers only
    aligned = [align_to_schema(spark.read.parquet(*group), _layout(feed)) for group in same.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def load_months(spark: SparkSession, feed: str, landing: str, raw_root: str, references: Sequence[dt.date]) -> int:
    """Plant generation or capacity: the last closed month before each reference day."""
    months = backfill.closed_months_before(references)
    return _append(
        spark, feed, raw_root, max(references), lambda: _read_files(spark, feed, _published(landing, feed, months))
    )


def load_schedule(
    spark: SparkSession, landing: str, raw_root: str, days: Sequence[dt.date] = (), today: dt.date | None = None
) -> int:
    """Schedule files of the given days, by default of yesterday."""
    wanted = list(days) or [(today or dt.date.today()) - dt.timedelta(days=v.SCHEDULE_LAG_DAYS)]
    return _append(
        spark, "programacao", raw_root, max(wanted),
        lambda: _read_files(spark, "programacao", _published(landing, "programacao", wanted)),
    )


def load_demand(
    spark: SparkSession, landing: str, raw_root: str, reference: dt.date, window_days: int = v.LOAD_WINDOW_DAYS
) -> int:
    """Load of a trailing window, re-read so that revisions arrive; nothing else is filtered here."""
    first = reference - dt.timedelta(days=window_days)
    years = {year: _published(landing, "carga", [dt.date(year, 1, 1)])[0] for year in dates.years_between(first, reference)}

    def read() -> DataFrame:
        files = scans.read_years(spark, years, current_year=reference.year)
        return files.filter(dates.in_day_window("din_instante", reference, window_days))

    return _append(spark, "carga", raw_root, reference, read)


def weather_points(spark: SparkSession) -> DataFrame:
    """The points in request order; ``position`` is their place in every response."""
    rows = [(position, *point) for position, point in enumerate(v.WEATHER_POINTS)]
    return spark.createDataFrame(
        rows,
        "position int, ponto_id string, uf string, tipo_ponto string, latitude_requested double, longitude_requested double",
    )


def observed_periods(spark: SparkSession, reference: dt.date) -> DataFrame:
    """Month blocks of the default observation window (published with a delay)."""
    first, last = v.OBSERVED_LAG_DAYS
    return backfill.period_table(
        spark, reference - dt.timedelta(days=first), reference - dt.timedelta(days=last)
    )


def load_responses(
    spark: SparkSession, feed: str, landing: str, raw_root: str, reference: dt.date, where: str | None = None
) -> int:
    """Captured weather responses of a feed, one raw row per point and document.

    ``where`` selects documents by their folder columns and prunes the listing.
    """
    table = v.FEEDS[feed][2]
    layout = [part.split(" ") for part in v.RAW_LAYOUTS[table].split(", ")]
    points = weather_points(spark)
    own = {*points.columns, "raw_response", sinks.INGESTED_AT}
    shared = [(name, kind) for name, kind in layout if name not in own]

    def read() -> DataFrame:
        documents = spark.read.text(f"{landing.rstrip('/')}/{feed}", wholetext=True).select(
            "*", F.col("_metadata.file_path").alias("file")
        )
        if where is not None:
            documents = documents.filter(where)
        typed = documents.withColumns({name: F.col(name).cast(kind) for name, kind in shared})
        rows = scans.responses_by_position(
            typed, "value", "file", points, "position", "raw_response", [name for name, _ in shared]
        )
        return rows.select(*[name for name, _ in layout if name != sinks.INGESTED_AT])

    return _append(spark, feed, raw_root, reference, read)
