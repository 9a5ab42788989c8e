"""Rows brought to a declared layout without losing a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LossyConversion(Exception):
    """A value does not survive the conversion to the type of its column."""

    def __init__(self, losses: dict[str, int]):
        super().__init__("; ".join(f"{name!r}: {count} values do not convert" for name, count in losses.items()))
        self.losses = losses


def survives(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """Null and blank text survive as null; text if it parses; anything else if casting back gives it again."""
    converted = value.try_cast(wanted)
    if isinstance(given, T.StringType):
        return F.coalesce(F.trim(value) == "", F.lit(True)) | converted.isNotNull()
    return converted.try_cast(given).eqNullSafe(value)


def conversion_losses(df: DataFrame, conversions: dict[str, T.DataType]) -> DataFrame:
    """One row with the number of lost values per converted column."""
    given = {field.name: field.dataType for field in df.schema}
    return df.agg(*[F.count_if(~survives(F.col(name), given[name], kind)).alias(name) for name, kind in conversions.items()])


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the layout's types for the columns that both have.

    Only if a type differs does a job run: one pass counts the losses of all such
    columns, and any loss raises before something is written.
    """
    target = {field.name: field.dataType for field in schema}
    differing = {f.name: target[f.name] for f in df.schema if f.name in target and f.dataType != target[f.name]}
    if not differing:
        return df
    counted = conversion_losses(df, differing).first()
    if any(counted):
        raise LossyConversion({name: counted[name] for name in differing if counted[name]})
    return df.select(*[F.col(c).try_cast(differing[c]).alias(c) if c in differing else F.col(c) for c in df.columns])
