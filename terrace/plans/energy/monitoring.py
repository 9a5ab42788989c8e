"""Monitoring datasets over the audit log, run events, rule counts and quarantine tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import dates, nested
from terrace.sources.audit import FAILED, SUCCESS

# Display zone, horizon and list length of the monitoring datasets.
DISPLAY_ZONE = "America/Sao_Paulo"
RECENT_DAYS = 30
LATEST_RUNS = 50
VALIDATED_SUFFIX = "_validada"
EXPECTATION_FIELDS = "name STRING, dataset STRING, passed_records BIGINT, failed_records BIGINT"
EXPECTATIONS_PATH = "$.flow_progress.data_quality.expectations"
STATE_PATH = "$.update_progress.state"
PROGRESS_EVENT, QUALITY_EVENT = "update_progress", "flow_progress"


def _recent(df: DataFrame, instant: str, now: Column | None) -> DataFrame:
    moment = F.current_timestamp() if now is None else now
    return df.filter(dates.within_last_days(instant, moment, RECENT_DAYS))


def summary(audit: DataFrame, quarantines: Sequence[DataFrame], now: Column | None = None) -> DataFrame:
    """Recent runs, failed runs and all quarantined rows, in one row."""
    runs = _recent(audit, "execution_timestamp", now).agg(
        F.struct(F.count("*").alias("all"), F.count_if(F.col("status") == FAILED).alias("failed")).alias("_runs")
    ).scalar()
    counts = reduce(DataFrame.unionByName, [q.agg(F.count("*").alias("_n")) for q in quarantines])
    held = counts.agg(F.sum("_n")).scalar()
    return audit.sparkSession.range(1).select(
        runs["all"].alias("execucoes_ingestao"),
        runs["failed"].alias("falhas_ingestao"),
        held.alias("registros_em_quarentena"),
    )


def rows_per_day(audit: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows written per local day and pipeline by successful runs."""
    day = dates.local_time("execution_timestamp", DISPLAY_ZONE).cast("date")
    return (
        _recent(audit.filter(F.col("status") == SUCCESS), "execution_timestamp", now)
        .groupBy(day.alias("dia"), F.col("pipeline_name").alias("notebook"))
        .agg(F.sum("linhas_gravadas").alias("linhas"))
    )


def latest_runs(audit: DataFrame) -> DataFrame:
    """Most recent runs; the pipeline name orders runs of the same instant."""
    return (
        audit.orderBy(F.desc("execution_timestamp"), "pipeline_name")
        .limit(LATEST_RUNS)
        .select(
            dates.local_time("execution_timestamp", DISPLAY_ZONE).alias("inicio_brasilia"),
            F.col("pipeline_name").alias("notebook"),
            "status",
            "linhas_gravadas",
            "duracao_segundos",
            "erro",
        )
    )


def progress_from_log(log: DataFrame, layer: str) -> DataFrame:
    """Progress events of one layer out of a JSON event log: ``camada, update_id, timestamp, estado``."""
    return log.filter(F.col("event_type") == PROGRESS_EVENT).select(
        F.lit(layer).alias("camada"),
        F.col("origin.update_id").alias("update_id"),
        "timestamp",
        nested.json_path("details", STATE_PATH).alias("estado"),
    )


def update_runs(events: Sequence[DataFrame], now: Column | None = None) -> DataFrame:
    """Start, duration and last state of every recent refresh, per layer."""
    recent = _recent(reduce(DataFrame.unionByName, events), "timestamp", now)
    return (
        recent.groupBy("camada", "update_id")
        .agg(
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
            F.max_by("estado", "timestamp").alias("estado"),
        )
        .select(
            "camada",
            dates.local_time("_first", DISPLAY_ZONE).alias("inicio_brasilia"),
            F.round(dates.minutes_between("_first", "_last"), 1).alias("duracao_min"),
            "estado",
        )
    )


def counts_from_log(log: DataFrame) -> DataFrame:
    """Rule counts out of a JSON event log: ``table, rule, passed, failed``."""
    rules = nested.json_records(nested.json_path("details", EXPECTATIONS_PATH), EXPECTATION_FIELDS)
    return (
        log.filter(F.col("event_type") == QUALITY_EVENT)
        .select(F.explode(rules).alias("e"))
        .filter(F.endswith(F.col("e.dataset"), F.lit(VALIDATED_SUFFIX)))
        .select(
            F.replace(F.col("e.dataset"), F.lit(VALIDATED_SUFFIX), F.lit("")).alias("table"),
            F.col("e.name").alias("rule"),
            F.col("e.passed_records").alias("passed"),
            F.col("e.failed_records").alias("failed"),
        )
    )


def rule_totals(counts: DataFrame) -> DataFrame:
    """Passed and failed rows per table and rule over all runs."""
    return counts.groupBy(F.col("table").alias("tabela"), F.col("rule").alias("regra")).agg(
        F.sum("passed").alias("aprovados"), F.sum("failed").alias("reprovados")
    )
