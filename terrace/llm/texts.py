"""Column functions over whole texts, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of anything but white space; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def each_index(size: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """``[body(0), ..., body(size - 1)]``, empty for sizes below 1; ``kind`` is the array's type."""
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), body)).otherwise(F.array().cast(kind))


def running(values: Column, both: Callable[[Column, Column], Column]) -> Column:
    """For each of the whole numbers (none below 0), what ``both`` makes of those before it, 0 for none.

    Blocks of about the square root of their number are summed up first, so that no element looks
    at all that are before it and no array is copied per element.
    """
    fold = lambda x: F.aggregate(x, F.lit(0), both)
    whole = lambda x: F.floor(x).cast("int")

    def of(v: Column, width: Column) -> Column:
        blocks = each_index(F.ceil(F.size(v) / width).cast("int"), lambda b: fold(F.slice(v, b * width + 1, width)), "array<int>")
        before = lambda told: each_index(F.size(told), lambda b: fold(F.slice(told, F.lit(1), b)), "array<int>")
        each = lambda starts: each_index(
            F.size(v), lambda i: both(F.get(starts, whole(i / width)), fold(F.slice(v, whole(i / width) * width + 1, i % width))), "array<int>"
        )
        return let(blocks, lambda told: let(before(told), each))

    return let(values, lambda v: let(F.greatest(F.lit(1), whole(F.sqrt(F.size(v)))), lambda width: of(v, width)))


CHUNK = 4_096


def chunks_of(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` characters, for ``cut``."""
    return each_index(F.ceil(F.length(text) / CHUNK).cast("int"), lambda c: F.substring(text, c * CHUNK + 1, F.lit(CHUNK)), "array<string>")


def cut(chunks: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` to ``end`` (exclusive), without a walk from the beginning of the text."""
    first = F.floor(start / CHUNK).cast("int")
    held = F.array_join(F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
    return F.substring(held, start % CHUNK + 1, end - start)
