"""Row rules: mark, split, quarantine and count.

A rule is a named SQL condition. *Drop* rules treat a null outcome as a
violation; *warn* rules only count rows, and a null outcome passes.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.nested import names_where

Rules = Mapping[str, str]


def holds(condition: str, when_null: bool) -> Column:
    """The rule's outcome with nulls decided."""
    return F.coalesce(F.expr(f"({condition})"), F.lit(when_null))


def violations(rules: Rules) -> Column:
    """Names of the violated drop rules, in declaration order."""
    return names_where((name, ~holds(text, when_null=False)) for name, text in rules.items())


def passes_all(rules: Rules) -> Column:
    return reduce(Column.__and__, (holds(text, when_null=False) for text in rules.values()), F.lit(True))


def mark_violations(df: DataFrame, rules: Rules, column: str) -> DataFrame:
    return df.withColumn(column, violations(rules))


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that satisfy every drop rule.

    A filter drops null outcomes by itself, so the rules go in bare and those on
    stored columns reach the scan as pushed filters.
    """
    return reduce(DataFrame.filter, (f"({text})" for text in rules.values()), df)


def quarantine(df: DataFrame, rules: Rules, column: str) -> DataFrame:
    """Rows that violate at least one drop rule, with the names of those rules.

    The filter tests the conditions, so the array is built for the held rows only.
    """
    return mark_violations(df.filter(~passes_all(rules)), rules, column)


def rule_counts(df: DataFrame, drop: Rules, warn: Rules, table: str) -> DataFrame:
    """One row per rule: ``table, rule, kind, passed, failed``, in one pass over ``df``.

    Drop rules are counted over all rows, warn rules over the rows that remain
    after dropping, which are the rows a reader of the clean table sees.
    """
    kept = passes_all(drop)
    outcomes = [(name, "drop", holds(text, when_null=False), F.lit(True)) for name, text in drop.items()]
    outcomes += [(name, "warn", holds(text, when_null=True), kept) for name, text in warn.items()]
    counts, records = [], []
    for position, (name, kind, good, counted) in enumerate(outcomes):
        counts += [
            F.count_if(counted & good).alias(f"p{position}"),
            F.count_if(counted & ~good).alias(f"f{position}"),
        ]
        records.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(name).alias("rule"),
                F.lit(kind).alias("kind"),
                F.col(f"p{position}").alias("passed"),
                F.col(f"f{position}").alias("failed"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*records)))
