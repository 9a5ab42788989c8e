"""Dependencies and mergeable quantiles against plain Python."""

import random
from itertools import combinations

import pytest

from terrace.operators import dependencies, sketches
from tests.conftest import frame


def by_hand(rows, names, most):
    classes = lambda x: len({tuple(r[names.index(c)] for c in sorted(x)) for r in rows})
    out = set()
    for size in range(most + 1):
        for x in combinations(names, size):
            for a in names:
                if a not in x and classes(x) == classes({*x, a}) and not any(set(d) < set(x) for d, b, _ in out if b == a):
                    out.add((x, a, classes(x)))
    return out


@pytest.mark.parametrize("seed, most", [(1, 2), (2, 3), (3, 1)])
def test_dependencies_equal_brute_force(spark, seed, most):
    dice = random.Random(seed)
    names = ["a", "b", "c", "d + e", "f", "g"]
    rows = []
    for i in range(40):
        a, b = dice.choice([None, 1, 2, 3]), dice.choice([None, "x", "y"])
        rows.append((a, b, None if a is None else a % 2, f"{a}{b}", 7, i if seed != 2 else i // 2))
    df = spark.createDataFrame(rows, "a int, b string, c int, `d + e` string, f int, g int")
    got = {(tuple(r.determinant), r.dependent, r.classes) for r in dependencies.column_dependencies(df, most_columns=most).collect()}
    assert got == by_hand(rows, names, most)
    assert (("a", "b"), "d + e", len({r[3] for r in rows})) in got or most == 1


def test_each_level_is_one_scan(spark, monkeypatch):
    calls = []
    count = dependencies.class_counts
    monkeypatch.setattr(dependencies, "class_counts", lambda df, sets: calls.append(len(sets)) or count(df, sets))
    df = frame(spark, "a int, b int, c int, d int", (1, 1, 1, 1), (1, 2, 2, 1), (2, 1, 2, 2), (2, 2, 1, 1), (2, 2, 1, 1))
    dependencies.column_dependencies(df, most_columns=2)
    assert len(calls) == 3
    plan = count(df, [["a"], ["b"], ["a", "b"]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_an_empty_table_and_null_marks(spark):
    assert dependencies.column_dependencies(spark.createDataFrame([], "a int, b int")).count() == 0
    df = frame(spark, "a int, b int", (None, 1), (1, None), (None, None))
    assert {r.classes for r in dependencies.class_counts(df, [["a", "b"]]).collect()} == {3}


def test_sketches_of_parts_merge_within_their_error(spark):
    dice = random.Random(6)
    rows = [(dice.choice(["x", "y", None]), dice.randrange(12), None if dice.random() < 0.05 else dice.gauss(0, 50) ** 2) for _ in range(20_000)]
    df = spark.createDataFrame([*rows, ("x", 1, float("nan")), ("none", 1, None)], "g string, month int, v double")
    parts = sketches.quantile_sketches(df, ["g", "month"], "v")
    found = sketches.quantiles(sketches.merged_sketches(parts, ["g"]), ["g"], [0.0, 0.25, 0.5, 0.99, 1.0])
    told = sketches.rank_errors(df, found, ["g"], "v").collect()
    assert {r.g for r in told} == {"x", "y", None} and len(told) == 15 and max(r.rank_error for r in told) <= 0.01
    least = min(v for g, _, v in rows if g == "x" and v is not None)
    assert next(r.quantile for r in told if r.g == "x" and r.share == 0.0) == least


def test_distinct_counts_of_increments_are_exact(spark):
    """Ids in several months and parts, a part that arrives twice, nulls, negative and very large ids."""
    dice = random.Random(8)
    ids = [None, -5, 0, 1, 32_767, 32_768, 32_769, 2**40, 2**62, *range(100, 400)]
    rows = [(dice.choice(["x", "y", None]), dice.randrange(4), i, dice.choice([None, "p", "q"])) for i in dice.choices(ids, k=3_000)]
    parts = [spark.createDataFrame(p, "g string, month int, id long, kind string") for p in (rows[:1_000], rows[1_000:], rows[:1_000])]
    made = [sketches.id_bitmaps(p, ["g", "month"], "id") for p in parts]
    kept = made[0].unionByName(made[1]).unionByName(made[2])
    got = {(r.g, r.month): r["distinct"] for r in sketches.distinct_ids(kept, ["g", "month"]).collect()}
    assert got == {(g, m): len({r[2] for r in rows if r[:2] == (g, m)} - {None}) for g, m in {r[:2] for r in rows}}
    whole = {r.g: r["distinct"] for r in sketches.distinct_ids(sketches.merged_bitmaps(kept, ["g"]), ["g"]).collect()}
    assert whole == {g: len({r[2] for r in rows if r[0] == g} - {None}) for g in ("x", "y", None)}
    sets = [sketches.key_sets(p, ["g", "month"], ["id", "kind"]) for p in parts]
    both = sketches.distinct_keys(sets[0].unionByName(sets[1]).unionByName(sets[2]), ["g"], ["id", "kind"])
    assert {r.g: r["distinct"] for r in both.collect()} == {g: len({r[2:] for r in rows if r[0] == g and None not in r[2:]}) for g in ("x", "y", None)}
    assert sketches.distinct_ids(sketches.id_bitmaps(parts[0].limit(0), ["g"], "id"), ["g"]).collect() == []
