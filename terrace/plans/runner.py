"""Jobs that build clean tables and metric tables from their declarations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from terrace.operators import quality
from terrace.operators.history import change_history, latest_per_key, with_business_names
from terrace.plans.spec import (
    SEQUENCE,
    VERSION_COLUMNS,
    VIOLATED,
    CleanTable,
    MetricTable,
    check_schema,
    in_dependency_order,
)
from terrace.session import require_utc
from terrace.sources.sinks import MonthlySnapshot, Snapshot
from terrace.streaming.apply import IncrementalTable


def clean_batch(spark: SparkSession, table: CleanTable, *raw: DataFrame) -> dict[str, DataFrame]:
    """All objects of a clean table as lazy DataFrames over one raw batch.

    For stored, incrementally kept tables use ``streaming.apply.IncrementalTable``,
    which gives the same rows.
    """
    require_utc(spark)
    standardized = table.standardize(*raw)
    check_schema(standardized, table.stored, table.name)
    valid = quality.keep_valid(standardized, table.drop_rules)
    made = {
        table.name: latest_per_key(valid, table.key, SEQUENCE),
        f"{table.name}_quarentena": quality.quarantine(standardized, table.drop_rules, VIOLATED),
        f"{table.name}_regras": quality.rule_counts(standardized, table.drop_rules, table.warn_rules, table.name),
    }
    if table.versioned:
        past = change_history(valid, table.key, SEQUENCE, table.versioned, number="_number")
        made[f"{table.name}_historico_cdc"] = past.drop("_number")
        made[f"{table.name}_versoes"] = with_business_names(past, "_number", SEQUENCE, VERSION_COLUMNS)
    return made


def compute_metrics(tables: Sequence[MetricTable], clean: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Metric tables as lazy DataFrames, inputs before readers."""
    made: dict[str, DataFrame] = {}
    for table in in_dependency_order(tables):
        inputs = [clean(name) for name in table.clean_inputs] + [made[name] for name in table.metric_inputs]
        result = table.compute(*inputs)
        check_schema(result, table.columns, table.name)
        made[table.name] = result
    return made


def refresh_metrics(
    tables: Sequence[MetricTable], clean: Callable[[str], DataFrame], root: str
) -> dict[str, DataFrame]:
    """Recompute and publish metric tables; readers of a metric table read its stored rows."""
    made: dict[str, DataFrame] = {}
    for table in in_dependency_order(tables):
        inputs = [clean(name) for name in table.clean_inputs] + [made[name] for name in table.metric_inputs]
        result = table.compute(*inputs)
        check_schema(result, table.columns, table.name)
        made[table.name] = Snapshot(f"{root.rstrip('/')}/{table.name}").refresh(result)
    return made


def published(spark: SparkSession, table: MetricTable, root: str) -> DataFrame:
    """A metric table as ``refresh_changed`` last left it."""
    path = f"{root.rstrip('/')}/{table.name}"
    return (Snapshot(path) if table.month_column is None else MonthlySnapshot(path, table.month_column)).read(spark)


def refresh_changed(
    spark: SparkSession, tables: Sequence[MetricTable], states: Mapping[str, IncrementalTable], root: str
) -> dict[str, DataFrame]:
    """Bring published metric tables up to date, reading only months of clean tables that changed since.

    A table whose rows belong to one month each is recomputed for the months in which one of its
    inputs changed, so a replaced value leaves no trace. A table that gathers months reads
    other metric tables, whose rows are already summed up, and only if one of them was refreshed.
    """
    made: dict[str, DataFrame] = {}
    refreshed: set[str] = set()
    for table in in_dependency_order(tables):
        path = f"{root.rstrip('/')}/{table.name}"
        if table.month_column is None:
            if not refreshed.isdisjoint(table.metric_inputs) or table.clean_inputs or not Snapshot(path).exists(spark):
                result = table.compute(*[states[n].current(spark) for n in table.clean_inputs], *[made[n] for n in table.metric_inputs])
                check_schema(result, table.columns, table.name)
                Snapshot(path).refresh(result)
                refreshed.add(table.name)
        else:
            if table.metric_inputs:
                raise ValueError(f"{table.name}: a table refreshed by month reads clean tables only")
            target = MonthlySnapshot(path, table.month_column)
            now = {name: states[name].months(spark) for name in table.clean_inputs}
            before = target.seen(spark)
            marks = [(now[n], (before or {}).get(n, {})) for n in now]
            changed = sorted({m for new, old in marks for m in {*new, *old} if new.get(m) != old.get(m)})
            if changed or before is None:
                result = table.compute(*[states[n].current(spark, changed) for n in table.clean_inputs])
                check_schema(result, table.columns, table.name)
                target.refresh(result, changed, now)
                refreshed.add(table.name)
        made[table.name] = published(spark, table, root)
    return made
