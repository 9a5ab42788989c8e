"""One layout for files that were published with different ones.

The types of a column in all files meet in the narrowest type that holds them: wider integers,
decimals with room for both sides, doubles, instants for days, and text where nothing else
is left. Files of one layout are one scan; a scan whose types differ from the common ones is
converted, and the conversion is checked to lose no value before any row is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrace.sources.align import align_to_schema

#: Decimal digits that hold every value of an integer type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_INSTANTS = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _DIGITS.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def least_common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both convert to; text if there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda kind: _DIGITS[type(kind)])
    number = lambda kind: _as_decimal(kind) is not None or isinstance(kind, (T.FloatType, T.DoubleType))
    if number(a) and number(b):
        one, other = _as_decimal(a), _as_decimal(b)
        if one is None or other is None:
            return T.DoubleType()
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, _INSTANTS) and isinstance(b, _INSTANTS):
        return max(a, b, key=lambda kind: _INSTANTS.index(type(kind)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(least_common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        return T.StructType([T.StructField(f.name, least_common_type(f.dataType, b[f.name].dataType), True) for f in a])
    return T.StringType()


def common_layout(layouts: Sequence[T.StructType]) -> T.StructType:
    """All columns in the order in which they first appear, each in the least common type of its types."""
    kinds: dict[str, T.DataType] = {}
    for layout in layouts:
        for field in layout:
            kinds[field.name] = least_common_type(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds.items()])


def read_layouts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files as one frame. Raises ``LossyConversion`` if a value does not survive the common type."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        layout = spark.read.parquet(path).schema  # footers only
        groups.setdefault(layout.json(), (layout, []))[1].append(path)
    wanted = common_layout([layout for layout, _ in groups.values()])
    scans = [align_to_schema(spark.read.schema(layout).parquet(*own), wanted) for layout, own in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans).select(*wanted.names)
