"""Small helpers shared by the column functions."""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Union[str, Column]


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def column_or_null(df: DataFrame, name: str, data_type: str) -> Column:
    """The column if this layout has it, else a typed null (older layouts lack columns)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(data_type)


def with_default(value: ColumnLike, default: object) -> Column:
    return F.coalesce(as_column(value), F.lit(default))
