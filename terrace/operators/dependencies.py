"""Keys, and columns that others determine, from the sizes of row partitions.

A set of columns parts the rows into classes of equal values. The partition of two sets
together is the intersection of theirs, and a set determines a column exactly if adding the
column leaves the number of classes as it is. The search goes level by level: all partitions of a
level are counted in one scan, in sums that combine before the shuffle, and what a level
finds leaves out sets on the next one. Only counts reach the driver, one per set.

Defined results: null is a value like any other. Only least determinants are reported, a constant column by
the empty set. Classes are told apart by two 64-bit hashes. An empty table has no
dependencies.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_COLUMNS = 2
REPORT = "determinant array<string>, dependent string, classes long"


def _class_of(columns: Sequence[str], seed: int) -> Column:
    """A hash of the row's class; each column is hashed with its null mark, as the function passes over nulls."""
    if not columns:
        return F.lit(0).cast("long")
    return F.xxhash64(*[F.xxhash64(F.lit(seed), F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns])


def class_counts(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """(set, classes, rows) for each set of columns, by its place in ``sets``: one scan for all."""
    marks = [F.struct(F.lit(i).alias("set"), _class_of(c, 0).alias("a"), _class_of(c, 1).alias("b")) for i, c in enumerate(sets)]
    classes = df.select(F.explode(F.array(*marks)).alias("x")).groupBy("x.set", "x.a", "x.b").agg(F.count("*").alias("n"))
    return classes.groupBy("set").agg(F.count("*").alias("classes"), F.sum("n").alias("rows"))


def _counted(df: DataFrame, sets: Iterable[frozenset[str]]) -> dict[frozenset[str], tuple[int, int]]:
    listed = sorted(sets, key=sorted)
    if not listed:
        return {}
    return {listed[r["set"]]: (r["classes"], r["rows"]) for r in class_counts(df, [sorted(x) for x in listed]).collect()}


def column_dependencies(df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = MOST_COLUMNS) -> DataFrame:
    """(determinant, dependent, classes): all least sets of at most ``most_columns`` columns that determine a column.

    ``classes`` is the number of different values of the determinant. A key determines every other column.
    """
    names = sorted(columns or df.columns)
    found: list[tuple[list[str], str, int]] = []
    determined: dict[str, list[frozenset[str]]] = {n: [] for n in names}

    def report(determinant: frozenset[str], dependent: str, classes: int) -> None:
        found.append((sorted(determinant), dependent, classes))
        determined[dependent].append(determinant)

    sizes = _counted(df, [frozenset(), *[frozenset([n]) for n in names]])
    rows = sizes[frozenset()][1] if sizes else 0
    constant = {n for n in names if sizes and sizes[frozenset([n])][0] == 1}
    if rows:
        for name in sorted(constant):
            report(frozenset(), name, 1)
    keys: list[frozenset[str]] = []
    for size in range(1, most_columns + 1 if rows else 1):
        # A set that holds a key or a column that the rest of it determines is not least.
        open_sets = [
            x for x in map(frozenset, combinations([n for n in names if n not in constant], size))
            if not any(k < x for k in keys) and not any(d <= x - {n} for n in x for d in determined[n])
        ]
        wanted = {x: [n for n in names if n not in x and n not in constant and not any(d < x for d in determined[n])] for x in open_sets}
        whole = [x for x in open_sets if sizes[x][0] == rows]
        unions = {x | {n} for x in open_sets if x not in whole for n in wanted[x]}
        sizes |= _counted(df, unions - set(sizes))
        for x in open_sets:
            for name in wanted[x]:
                if x in whole or sizes[x | {name}][0] == sizes[x][0]:
                    report(x, name, sizes[x][0])
        keys += whole
    return df.sparkSession.createDataFrame(found, REPORT)
