"""Profiling operators."""

import pytest

from terrace.functions import numeric
from terrace.operators import metrics, profile
from tests.conftest import frame


def test_centroid_and_share(spark):
    plants = frame(spark, "uf string, kind string, cap double, lat double, lon double",
                   ("BA", "w", 1, -10, -40), ("BA", "w", 3, -14, -44), ("CE", "w", 4, -3, -39), ("CE", "s", 5, -5, -38))
    got = {(r["uf"], r["kind"]): r for r in profile.weighted_centroid(
        plants, ["uf", "kind"], ["kind"], "cap", {"lat": "lat", "lon": "lon"}, "total", "share").collect()}
    assert (got["BA", "w"]["lat"], got["BA", "w"]["lon"], got["BA", "w"]["share"]) == (-13, -43, 0.5)
    assert got["CE", "s"]["share"] == 1


def test_keys(spark):
    df = frame(spark, "a int, b int, c int", (1, 1, 1), (1, 2, 1), (2, 1, 1), (None, 1, 1))
    report = profile.key_candidates(df, [["a"], ["a", "b"], ["a", "b", "c"]])
    assert [(r["distinct_rows"], r["is_key"]) for r in report.orderBy("columns").collect()] == [(3, False), (4, True), (4, True)]
    assert profile.smallest_key(report).first()["candidate"] == "a + b"


def test_all_smallest_keys_and_the_search(spark):
    df = frame(spark, "a int, b int, c int, d int", (1, 1, 1, 7), (1, 2, 2, 7), (2, 1, 2, 7), (None, 1, 3, 7))
    report = profile.key_candidates(df, [["a", "b"], ["a", "c"], ["a", "b", "c"], ["b", "d"]])
    assert sorted(r["candidate"] for r in profile.smallest_key(report).collect()) == ["a + b", "a + c"]
    assert sorted(r["candidate"] for r in profile.natural_keys(df).collect()) == ["a + b", "a + c", "b + c"]
    assert profile.natural_keys(df, ["d"]).count() == 0
    assert [r["candidate"] for r in profile.natural_keys(df.limit(0), ["a", "d"]).orderBy("candidate").collect()] == ["a", "d"]


def test_profile(spark):
    df = frame(spark, "a int, b string", (1, "x"), (-2, None), (None, None))
    a, b = sorted(profile.column_profile(df).collect(), key=lambda r: r["column"])
    assert (a["rows"], a["nulls"], a["lowest"], a["highest"], a["negatives"]) == (3, 1, "-2", "1", 1)
    assert b["nulls"] == 2 and b["negatives"] is None and b["null_share"] == pytest.approx(2 / 3)


def test_duplicates(spark):
    df = frame(
        spark, "k string, v double, batch int",
        ("once", 1, 1), ("tech", 1, 1), ("tech", 1, 1), ("again", 1, 1), ("again", 1, 2),
        ("differs", 1, 1), ("differs", 2, 1), ("nulls", None, 1), ("nulls", None, 1), ("half", None, 1), ("half", 1, 2),
    )
    got = {r["k"]: r["class"] for r in profile.duplicate_classes(df, ["k"], ["v"], "batch").collect()}
    assert got == {"tech": "technical", "again": "reingested", "differs": "apparent", "nulls": "technical", "half": "apparent"}


def test_derived_column(spark):
    df = frame(spark, "f double, g double, c double", (0.5, 1, 2), (0.9, 1, 2), (None, 1, 2), (0.5, 1, 0))
    got = profile.derived_check(df, "f", numeric.ratio("g", "c"), 0.001).first()
    assert (got["rows"], got["mismatches"], got["not_comparable"]) == (4, 1, 2)


def test_weekend_effect(spark):
    df = frame(spark, "v double, t double, w boolean", (10, 1, False), (20, 2, False), (12, 1.2, True))
    got = profile.weekend_effect(df, "v", "t", "w").first()
    assert got["weekend_change"] == pytest.approx(-0.2) and got["correlation"] == pytest.approx(1)


def test_match_report(spark):
    left = frame(spark, "k int", (1,), (1,), (2,))
    right = frame(spark, "k int", (1,), (3,), (3,))
    assert tuple(metrics.match_report(left, right, ["k"]).first()) == (2, 1, 2)


def test_bins_of_negative_values_go_down(spark):
    df = frame(spark, "x double", (-0.5,), (0.0,), (7.49,), (7.5,))
    assert [r[0] for r in df.select(numeric.bin_start("x", 7.5)).collect()] == [-7.5, 0, 0, 7.5]
