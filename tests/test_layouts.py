"""Common types of files, and differences of tables against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from terrace.operators import difference
from terrace.sources.align import LossyConversion
from terrace.sources.layouts import common_layout, least_common_type, read_layouts
from tests.conftest import frame


@pytest.mark.parametrize(
    "a, b, wanted",
    [
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "double", "double"),
        ("float", "int", "double"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(10,9)", "double"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "int", "string"), ("boolean", "int", "string"),
        ("string", "double", "string"), ("void", "date", "date"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int,b:date>", "struct<a:double,b:date>", "struct<a:double,b:date>"), ("struct<a:int>", "struct<b:int>", "string"),
    ],
)
def test_least_common_types(spark, a, b, wanted):
    kind = lambda text: T.StructType.fromDDL(f"c {text}")[0].dataType
    for left, right in ((a, b), (b, a)):
        assert least_common_type(kind(left), kind(right)).simpleString() == wanted


def test_order_of_files_does_not_matter_for_types(spark):
    layouts = [T.StructType.fromDDL(x) for x in ("a int, b date", "a bigint, c string", "b timestamp, a decimal(4,1)")]
    names = lambda x: {f.name: f.dataType.simpleString() for f in common_layout(x)}
    assert names(layouts) == names(layouts[::-1]) == {"a": "decimal(21,1)", "b": "timestamp", "c": "string"}


def test_files_of_mixed_types_are_one_frame(spark, tmp_path):
    made = {"a": "k int, v double", "b": "k bigint, v int, note string", "c": "k string, v decimal(6)", "d": "v float, k int"}
    for n, (name, schema) in enumerate(made.items()):
        names = [p.split()[0] for p in schema.split(", ")]
        rows = [tuple({"k": n * 10 + i, "v": i if i else None, "note": "x"}[c] for c in names) for i in range(3)]
        frame(spark, schema, *rows).write.parquet(str(tmp_path / name))
    got = read_layouts(spark, [str(tmp_path / name) for name in made])
    assert dict(got.dtypes) == {"k": "string", "v": "double", "note": "string"}
    assert {r.k for r in got.collect()} == {str(n * 10 + i) for n in range(4) for i in range(3)}
    assert Counter(r.v for r in got.collect()) == Counter({None: 4, 1.0: 4, 2.0: 4}) and got.filter("note = 'x'").count() == 3


def test_a_value_that_the_common_type_loses_is_an_error(spark, tmp_path):
    frame(spark, "k bigint", (2**53 + 1,)).write.parquet(str(tmp_path / "a"))
    frame(spark, "k double", (0.5,)).write.parquet(str(tmp_path / "b"))
    with pytest.raises(LossyConversion, match="k"):
        read_layouts(spark, [str(tmp_path / "a"), str(tmp_path / "b")])


def expected(left, right):
    out = {}
    for key in {r[0] for r in left} | {r[0] for r in right}:
        a, b = (Counter(r for r in rows if r[0] == key) for rows in (left, right))
        if a != b:
            out[key] = ("missing" if not b else "added" if not a else "changed", sum(a.values()), sum(b.values()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_differences_of_bags_of_rows(spark, seed):
    dice = random.Random(seed)
    row = lambda: (dice.choice([None, *range(12)]), dice.choice([None, "a", "b"]), dice.choice([None, 1, 2]))
    left = [row() for _ in range(30)]
    right = [r for r in left if dice.random() < 0.8] + [row() for _ in range(4)] + [(99, "new", None), (3, None, 1), (3, "a", None)]
    schema = "k int, a string, b int"
    got = difference.table_differences(frame(spark, schema, *left), frame(spark, schema, *right).select("b", "k", "a"), ["k"], buckets=5)
    assert {r.k: (r.difference, r.left_rows, r.right_rows) for r in got.collect()} == expected(left, right)
    same = frame(spark, schema, *left)
    assert difference.differing_buckets(same, same.repartition(7), ["k"]) == []
    empty = spark.createDataFrame([], schema)
    assert difference.table_differences(empty, empty, ["k"]).count() == 0
    with pytest.raises(ValueError, match="columns"):
        difference.table_differences(same, same.drop("a"), ["k"])


def test_only_differing_buckets_are_read_again(spark, tmp_path):
    rows = [(i, "x") for i in range(500)]
    frame_of = lambda rows: frame(spark, "k int, v string", *rows)
    difference.write_buckets(frame_of(rows), str(tmp_path / "a"), ["k"], 20)
    difference.write_buckets(frame_of([*rows[:77], (77, "y"), *rows[78:]]), str(tmp_path / "b"), ["k"], 20)
    sides = [spark.read.parquet(str(tmp_path / n)) for n in "ab"]
    found = difference.differing_buckets(*sides, ["k"], 20)
    made = difference.table_differences(*sides, ["k"], 20)
    assert len(found) == 1 and [tuple(r) for r in made.collect()] == [(77, "changed", 1, 1)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(key_bucket" in plan and f"= {found[0]})" in plan
