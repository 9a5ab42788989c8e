"""JSON and array helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column


def series_schema(
    variables: Iterable[str],
    suffix: str = "",
    series: str = "hourly",
    time: str = "time",
    scalars: Iterable[str] = ("latitude", "longitude"),
) -> str:
    """Schema text of a response that holds parallel arrays, one per variable.

    Elements are read as text, so one that is no number does not void its whole array.
    """
    arrays = [f"`{time}`: ARRAY<STRING>"] + [f"`{name}{suffix}`: ARRAY<STRING>" for name in variables]
    fields = [f"`{name}` DOUBLE" for name in scalars] + [f"`{series}` STRUCT<{', '.join(arrays)}>"]
    return ", ".join(fields)


def json_path(value: ColumnLike, path: str, data_type: str = "string") -> Column:
    """Value at a JSON path, null when it is absent or does not convert."""
    found = F.get_json_object(as_column(value), path)
    return found if data_type == "string" else found.try_cast(data_type)


def json_records(value: ColumnLike, fields: str) -> Column:
    """JSON text holding a list of records, as ARRAY<STRUCT<fields>> (use with ``explode``)."""
    return F.from_json(as_column(value), f"ARRAY<STRUCT<{fields}>>")


def json_elements(value: ColumnLike) -> Column:
    """Elements of a JSON document as raw JSON texts; a single object is a list of one."""
    text = as_column(value)
    return F.coalesce(F.from_json(text, "ARRAY<STRING>"), F.array(text))


def names_where(conditions: Iterable[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, in the given order, as ARRAY<STRING>."""
    marks = [F.when(condition, F.lit(name)) for name, condition in conditions]
    if not marks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*marks))
