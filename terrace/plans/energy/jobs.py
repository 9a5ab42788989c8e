"""The whole chain as jobs: raw -> clean -> metrics -> datasets.

An external scheduler starts them when raw tables change; each processes what
arrived since its last run and stops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.plans.energy import ingest, monitoring, reports, values as v
from terrace.plans.energy.catalog import CLEAN_TABLES, METRIC_TABLES
from terrace.plans.runner import published, refresh_changed
from terrace.plans.spec import CleanTable
from terrace.sources.audit import recorded_refresh
from terrace.sources.files import path_exists
from terrace.sources.scans import read_stream
from terrace.sources.sinks import export_csv
from terrace.streaming.apply import IncrementalTable

EVENTS = "eventos"


def clean_state(clean_root: str, table: CleanTable) -> IncrementalTable:
    return IncrementalTable(table, f"{clean_root.rstrip('/')}/{table.name}")


def raw_streams(spark: SparkSession, raw_root: str, table: CleanTable) -> list[DataFrame]:
    """The raw inputs as streams in their declared layout; columns a file lacks read as null."""
    streams = []
    for name in table.raw_tables:
        path = ingest.raw_path(raw_root, name)
        schema = T.StructType.fromDDL(v.RAW_LAYOUTS[name])
        if not path_exists(spark, path):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)
        streams.append(read_stream(spark, path, schema))
    return streams


def update_clean(
    spark: SparkSession, raw_root: str, clean_root: str, tables: Sequence[CleanTable] = CLEAN_TABLES, full: bool = False
) -> None:
    """Bring the clean tables up to date, or rebuild them from the raw tables."""
    with recorded_refresh(spark, f"{clean_root.rstrip('/')}/{EVENTS}", "silver"):
        for table in tables:
            state, streams = clean_state(clean_root, table), raw_streams(spark, raw_root, table)
            (state.full_refresh if full else state.run_available)(spark, *streams)


def update_metrics(spark: SparkSession, clean_root: str, metric_root: str) -> dict[str, DataFrame]:
    states = {table.name: clean_state(clean_root, table) for table in CLEAN_TABLES}
    with recorded_refresh(spark, f"{clean_root.rstrip('/')}/{EVENTS}", "gold"):
        return refresh_changed(spark, METRIC_TABLES, states, metric_root)


def metric_tables(spark: SparkSession, metric_root: str) -> dict[str, DataFrame]:
    return {t.name: published(spark, t, metric_root) for t in METRIC_TABLES}


def business_datasets(spark: SparkSession, metric_root: str, today: Column | None = None) -> dict[str, DataFrame]:
    return reports.build_all(metric_tables(spark, metric_root), today)


def monitoring_datasets(
    spark: SparkSession, raw_root: str, clean_root: str, now: Column | None = None
) -> dict[str, DataFrame]:
    audit = spark.read.parquet(ingest.audit_path(raw_root))
    states = [clean_state(clean_root, table) for table in CLEAN_TABLES]
    counts = states[0].rule_counts(spark)
    for state in states[1:]:
        counts = counts.unionByName(state.rule_counts(spark))
    events = spark.read.parquet(f"{clean_root.rstrip('/')}/{EVENTS}")
    return {
        "resumo": monitoring.summary(audit, [s.quarantine(spark) for s in states], now),
        "ingestao_diaria": monitoring.rows_per_day(audit, now),
        "ultimas_execucoes": monitoring.latest_runs(audit),
        "atualizacoes_pipelines": monitoring.update_runs([events], now),
        "qualidade": monitoring.rule_totals(counts),
    }


def export_metrics(spark: SparkSession, metric_root: str, target: str) -> None:
    """Metric tables as CSV folders."""
    for name, df in metric_tables(spark, metric_root).items():
        shown = df.select(
            *[F.col(f.name).cast("string") if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in df.schema]
        )
        export_csv(shown, f"{target.rstrip('/')}/{name}")
