"""Parallel-array JSON responses to one row per hour."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.dates import parse_hour
from terrace.functions.nested import series_schema


def explode_series(
    df: DataFrame,
    payload: str,
    context: Sequence[Column],
    variables: Mapping[str, Callable[[Column], Column]],
    outputs: Mapping[str, str],
    *,
    suffix: str = "",
    series: str = "hourly",
    time: str = "time",
    hour: str = "hour",
    scalars: Mapping[str, str] | None = None,
    parse: Callable[[Column], Column] = parse_hour,
) -> DataFrame:
    """One row per element of ``<series>.<time>`` with the value of every variable at that position.

    ``context``: columns computed from the source row and repeated on each hour.
    ``variables``: conversion per variable of the payload; ``outputs``: its column
    name. ``scalars``: payload field -> column name.

    The outer explode adds no ``size(...) > 0`` filter, which would parse every
    payload twice, and a payload that cannot be parsed stays as one row without an
    hour, so quality rules quarantine it instead of losing it. Shorter arrays give
    null beyond their end.
    """
    scalars = dict(scalars or {})
    schema = series_schema(variables, suffix, series, time, scalars)
    parsed = df.select(*context, F.from_json(payload, schema).alias("_parsed"))
    carried = parsed.columns[:-1]
    hours = parsed.select("*", F.posexplode_outer(f"_parsed.{series}.{time}").alias("_at", "_hour"))
    values = [
        convert(F.get(F.col(f"_parsed.{series}.{name}{suffix}"), F.col("_at")).try_cast("double")).alias(outputs[name])
        for name, convert in variables.items()
    ]
    return hours.select(
        *carried,
        parse(F.col("_hour")).alias(hour),
        *values,
        *[F.col(f"_parsed.{field}").alias(name) for field, name in scalars.items()],
    )
