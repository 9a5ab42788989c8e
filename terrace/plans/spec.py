"""Declarations of clean tables and metric tables, their contracts and their dictionary."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Technical columns of every clean table and the business names of versions.
SEQUENCE = "ingerido_em"
VIOLATED = "regras_violadas"
VERSION_COLUMNS = ("numero_versao", "vigente_desde", "vigente_ate", "versao_atual", "confirmado_em")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    comment: str = ""


SEQUENCE_COLUMN = Column(SEQUENCE, "timestamp", "Instant of the ingestion that last brought the row (UTC)")
VIOLATED_COLUMN = Column(VIOLATED, "array<string>", "Drop rules that the row violates")
HISTORY_COLUMNS = (
    Column("__START_AT", "timestamp", "Sequence at which the version began (technical)"),
    Column("__END_AT", "timestamp", "Sequence at which the version ended; null while in force (technical)"),
)
READABLE_COLUMNS = tuple(
    Column(name, kind, comment)
    for name, kind, comment in zip(
        VERSION_COLUMNS,
        ("int", "timestamp", "timestamp", "boolean", "timestamp"),
        (
            "Order of the version within its key, 1 is the first publication",
            "Ingestion in which this value appeared",
            "Ingestion that replaced this value; null while it is in force",
            "True for the version in force",
            "Last ingestion that brought this same value (UTC)",
        ),
        strict=True,
    )
)


def columns(*triples: tuple[str, str, str]) -> tuple[Column, ...]:
    return tuple(Column(*triple) for triple in triples)


def struct_of(cols: Iterable[Column]) -> T.StructType:
    """Schema with the comments in the field metadata, as Spark stores column comments."""
    schema = T.StructType()
    for column in cols:
        kind = T.StructType.fromDDL(f"c {column.type}").fields[0].dataType
        schema.add(T.StructField(column.name, kind, True, {"comment": column.comment}))
    return schema


def names_of(cols: Iterable[Column]) -> list[str]:
    return [column.name for column in cols]


@dataclass(frozen=True)
class CleanTable:
    """One clean table: where it comes from, how it is standardized, what makes it valid."""

    name: str
    source: str
    description: str
    raw_tables: tuple[str, ...]
    standardize: Callable[..., DataFrame]
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    drop_rules: Mapping[str, str]
    warn_rules: Mapping[str, str] = field(default_factory=dict)
    versioned: tuple[str, ...] = ()
    # Key column by whose month the stored state is partitioned: a run rewrites only
    # the months it touches.
    month_column: str | None = None
    # Parts of a month in the stored state, by a hash of the key: a run rewrites only
    # those it touches. A part should be small enough to be rebuilt within a run.
    state_buckets: int = 1

    @property
    def stored(self) -> tuple[Column, ...]:
        return (*self.columns, SEQUENCE_COLUMN)

    def objects(self) -> dict[str, tuple[Column, ...]]:
        """Every table this declaration produces, with its columns."""
        made = {self.name: self.stored, f"{self.name}_quarentena": (*self.stored, VIOLATED_COLUMN)}
        if self.versioned:
            made[f"{self.name}_historico_cdc"] = (*self.stored, *HISTORY_COLUMNS)
            made[f"{self.name}_versoes"] = (*self.columns, *READABLE_COLUMNS)
        return made

    def tags(self) -> dict[str, str]:
        return {"camada": "silver", "fonte": self.source, "dataset": self.name}


@dataclass(frozen=True)
class MetricTable:
    """One metric table, computed from clean tables and then from other metric tables."""

    name: str
    question: str
    description: str
    compute: Callable[..., DataFrame]
    columns: tuple[Column, ...]
    clean_inputs: tuple[str, ...] = ()
    metric_inputs: tuple[str, ...] = ()
    # Column whose month is that of all input rows behind a row: a refresh recomputes
    # only months whose inputs changed. None if rows gather several months.
    month_column: str | None = None

    def objects(self) -> dict[str, tuple[Column, ...]]:
        return {self.name: self.columns}

    def tags(self) -> dict[str, str]:
        return {"camada": "gold", "dataset": self.name}


class ContractError(Exception):
    pass


def check_schema(df: DataFrame, cols: Sequence[Column], label: str) -> None:
    """Names, order and types must be exactly the declared ones."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in struct_of(cols)]
    if found != wanted:
        raise ContractError(f"{label}: found {found}, declared {wanted}")


def check_definition(table: CleanTable, spark: SparkSession) -> None:
    """The declaration itself is consistent and its rules are valid SQL over its columns."""
    declared = names_of(table.columns)
    problems = []
    if len(set(declared)) != len(declared):
        problems.append("repeated column")
    if not table.key or not set(table.key) <= set(declared):
        problems.append("key outside the columns")
    if set(table.key) & set(table.versioned):
        problems.append("key column is versioned")
    if SEQUENCE in declared or SEQUENCE in table.versioned:
        problems.append("sequence declared as data")
    if not set(table.versioned) <= set(declared):
        problems.append("versioned column outside the columns")
    if table.month_column is not None and table.month_column not in table.key:
        problems.append("state partition outside the key")
    if set(table.drop_rules) & set(table.warn_rules):
        problems.append("rule name used twice")
    if problems:
        raise ContractError(f"{table.name}: {', '.join(problems)}")
    empty = spark.createDataFrame([], struct_of(table.stored))
    for name, condition in {**table.drop_rules, **table.warn_rules}.items():
        kind = empty.selectExpr(f"({condition}) AS outcome").schema[0].dataType
        if kind != T.BooleanType():
            raise ContractError(f"{table.name}: rule {name} is not a condition")


def dictionary(spark: SparkSession, tables: Iterable[CleanTable | MetricTable]) -> DataFrame:
    """Data dictionary as rows: layer, table, position, column, type, comment."""
    rows = [
        (table.tags()["camada"], name, position, column.name, column.type, column.comment)
        for table in tables
        for name, cols in table.objects().items()
        for position, column in enumerate(cols, start=1)
    ]
    schema = "layer string, table string, position int, column string, type string, comment string"
    return spark.createDataFrame(rows, schema)


def undocumented(dictionary_rows: DataFrame) -> DataFrame:
    """Columns without a comment (empty when the dictionary covers everything)."""
    return dictionary_rows.filter("comment IS NULL OR trim(comment) = ''")


def in_dependency_order(tables: Sequence[MetricTable]) -> list[MetricTable]:
    """Metric tables with every input before its reader."""
    by_name = {t.name: t for t in tables}
    placed: dict[str, MetricTable] = {}

    def place(table: MetricTable, path: tuple[str, ...]) -> None:
        if table.name in path:
            raise ContractError(f"metric tables depend on each other: {' -> '.join((*path, table.name))}")
        for needed in table.metric_inputs:
            if needed not in placed:
                place(by_name[needed], (*path, table.name))
        placed.setdefault(table.name, table)

    for table in tables:
        place(table, ())
    return list(placed.values())
