"""Current values and history: hand-made cases, properties, and long keys against brute force."""

import datetime as dt
import random

import pytest

from terrace.operators import history, timeline
from tests.conftest import frame

SCHEMA = "k string, at int, v double, note string"


def versions(df, **options):
    made = history.change_history(df, ["k"], "at", ["v"], **options)
    return sorted(
        (r["k"] or "", r["__START_AT"], r["__END_AT"], r["at"], r["v"], r["note"]) for r in made.collect()
    )


def brute(rows):
    """Reference result, one key at a time in plain Python."""
    small = lambda x: (x is not None, x)
    keyed = {}
    for k, at, v, note in rows:
        kept = keyed.setdefault(k, {})
        if at not in kept or (small(v), small(note)) > (small(kept[at][0]), small(kept[at][1])):
            kept[at] = (v, note)
    out = []
    for k, steps in keyed.items():
        runs = []
        for at in sorted(steps):
            v, note = steps[at]
            if runs and runs[-1]["v"] == v:
                runs[-1].update(at=at, note=note)
            else:
                runs.append({"start": at, "at": at, "v": v, "note": note})
        for run, following in zip(runs, runs[1:] + [None]):
            end = following["start"] if following else None
            out.append((k or "", run["start"], end, run["at"], run["v"], run["note"]))
    return sorted(out)


def sample(seed, size=400, keys=("a", "b", None), span=120):
    dice = random.Random(seed)
    return [
        (dice.choice(keys), dice.randrange(span), dice.choice([1.0, 1.0, 2.0, None]), dice.choice(["x", "y", None]))
        for _ in range(size)
    ]


def test_reads_with_the_same_value_only_confirm(spark):
    df = frame(spark, SCHEMA, ("NE", 43, 10, "a"), ("NE", 44, 10, "b"), ("NE", 50, 11, "c"), ("SE", 43, 7, "d"))
    assert versions(df) == [
        ("NE", 43, 50, 44, 10.0, "b"), ("NE", 50, None, 50, 11.0, "c"), ("SE", 43, None, 43, 7.0, "d"),
    ]


def test_a_value_that_returns_is_a_new_version(spark):
    df = frame(spark, SCHEMA, ("k", 1, 1, "a"), ("k", 2, 2, "b"), ("k", 3, 1, "c"))
    assert [(r[1], r[2]) for r in versions(df)] == [(1, 2), (2, 3), (3, None)]


def test_null_is_a_value(spark):
    df = frame(spark, SCHEMA, ("k", 1, None, "a"), ("k", 2, None, "b"), ("k", 3, 1, "c"), ("k", 4, None, "d"))
    assert [(r[1], r[3]) for r in versions(df)] == [(1, 2), (3, 3), (4, 4)]


@pytest.mark.parametrize("seed", range(3))
def test_ordinary_keys_equal_brute_force(spark, seed):
    rows = sample(seed)
    assert versions(frame(spark, SCHEMA, *rows)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("broadcast", [timeline.BROADCAST_LONG_KEYS, 0])
def test_long_keys_equal_brute_force(spark, monkeypatch, seed, broadcast):
    """A tiny threshold and tiny slices send most rows through the sliced way."""
    monkeypatch.setattr(timeline, "SLICE_ROWS", 7)
    monkeypatch.setattr(timeline, "BROADCAST_LONG_KEYS", broadcast)
    rows = sample(seed, keys=("a", "a", "a", "b", None)) + [("c", 5, 1.0, "x"), ("d", 5, 1.0, "x")] + [("a", 3, 2.0, "y")] * 50
    assert versions(frame(spark, SCHEMA, *rows), long_key_rows=60) == brute(rows)


def test_long_key_without_changes_is_one_version(spark, monkeypatch):
    monkeypatch.setattr(timeline, "SLICE_ROWS", 5)
    rows = [("a", i, 1.0, None) for i in range(100)]
    assert versions(frame(spark, SCHEMA, *rows), long_key_rows=10) == [("a", 0, None, 99, 1.0, None)]


@pytest.mark.parametrize("limit", [timeline.LONG_KEY_ROWS, 2])
def test_rows_without_an_order_value_are_kept(spark, limit):
    df = frame(spark, SCHEMA, ("a", None, 1, "x"), ("a", None, 2, "y"), ("a", 5, 3, "z"), ("a", 6, 3, "w"))
    placed = timeline.timeline(df, ["k"], "at", ["v"], long_key_rows=limit).orderBy(timeline.POSITION).collect()
    assert [(r["at"], r["v"], r[timeline.RUN]) for r in placed] == [(None, 2.0, 1), (5, 3.0, 2), (6, 3.0, 2)]


def test_slices_of_a_clustered_timeline_are_even(spark, monkeypatch):
    monkeypatch.setattr(timeline, "SLICE_ROWS", 500)
    df = spark.range(20_000).selectExpr("'a' AS k", "if(id = 0, -1000000000, id) AS at", "id AS v")
    _, rows = timeline.split_long_keys(df, ["k"], "at", 1_000)
    sizes = [r["count"] for r in rows.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1_000


def test_instants_as_text_are_sliced_evenly(spark, monkeypatch):
    """All begin with the same bytes; the slices follow what comes after them."""
    monkeypatch.setattr(timeline, "SLICE_ROWS", 500)
    instant = "date_format(timestamp '2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, id, 0, 0), \"yyyy-MM-dd'T'HH:mm\")"
    df = spark.range(6_000).selectExpr("if(id % 2 = 0, 'a', NULL) AS k", f"if(id = 7, NULL, {instant}) AS at", "id % 5 AS v")
    _, rows = timeline.split_long_keys(df, ["k"], "at", 1_000)
    sizes = [r["count"] for r in rows.groupBy("k", "_slice").count().collect()]
    assert sum(sizes) == 6_000 and max(sizes) <= 1_500
    whole, sliced = (history.change_history(df, ["k"], "at", ["v"], long_key_rows=n) for n in (10_000, 1_000))
    assert whole.exceptAll(sliced).count() == 0 and sliced.exceptAll(whole).count() == 0


def test_copies_of_few_instants_do_not_move_the_cuts(spark, monkeypatch):
    """Half the rows are copies of one instant: the others are still cut evenly, and the history is the same."""
    monkeypatch.setattr(timeline, "SLICE_ROWS", 500)
    df = spark.range(20_000).selectExpr("'a' AS k", "if(id % 2 = 0, 10000, id) AS at", "id % 9 AS v")
    _, rows = timeline.split_long_keys(df, ["k"], "at", 1_000)
    sizes = [r["n"] for r in rows.distinct().selectExpr("_slice", "at").distinct().groupBy("_slice").agg({"at": "count"}).toDF("s", "n").collect()]
    assert sum(sizes) == 10_001 and max(sizes) <= 1_000
    whole, sliced = (history.change_history(df, ["k"], "at", ["v"], long_key_rows=n) for n in (100_000, 1_000))
    assert whole.exceptAll(sliced).count() == 0 and sliced.exceptAll(whole).count() == 0


@pytest.mark.parametrize("kind", ["decimal(20, 3)", "double", "struct<at: bigint>", "binary"])
def test_a_sequence_of_any_sortable_type_is_sliced(spark, monkeypatch, kind):
    monkeypatch.setattr(timeline, "SLICE_ROWS", 50)
    value = {"struct<at: bigint>": "named_struct('at', id)", "binary": "CAST(lpad(string(id), 9, '0') AS BINARY)"}.get(kind, f"CAST(id AS {kind})")
    df = spark.range(2_000).selectExpr("'a' AS k", f"{value} AS at", "id DIV 7 % 5 AS v")
    _, rows = timeline.split_long_keys(df, ["k"], "at", 100)
    assert rows.select("_slice").distinct().count() > 20
    whole, sliced = (history.change_history(df, ["k"], "at", ["v"], long_key_rows=n) for n in (10_000, 100))
    assert whole.exceptAll(sliced).count() == 0 and sliced.exceptAll(whole).count() == 0


def test_a_text_sequence_gives_the_same_history_either_way(spark):
    df = spark.range(300).selectExpr("'a' AS k", "if(id % 50 = 0, NULL, concat('run-', lpad(string(id % 120), 4, '0'))) AS at", "id % 7 AS v")
    whole, sliced = (history.change_history(df, ["k"], "at", ["v"], long_key_rows=n) for n in (1_000, 10))
    assert whole.exceptAll(sliced).count() == 0 and sliced.exceptAll(whole).count() == 0


def test_long_key_of_one_instant(spark):
    rows = [("a", 1, float(i), None) for i in range(50)]
    assert versions(frame(spark, SCHEMA, *rows), long_key_rows=10) == [("a", 1, None, 1, 49.0, None)]


@pytest.mark.parametrize("limit", [timeline.LONG_KEY_ROWS, 20])
def test_positions_and_versions(spark, monkeypatch, limit):
    monkeypatch.setattr(timeline, "SLICE_ROWS", 4)
    df = frame(spark, SCHEMA, *sample(9))
    made = history.change_history(df, ["k"], "at", ["v"], number="n", long_key_rows=limit)
    names = ("number", "since", "until", "current", "confirmed")
    readable = history.readable_versions(made.drop("n"), ["k"], "at", names, long_key_rows=limit)
    assert sorted(map(str, readable.collect())) == sorted(
        map(str, history.with_business_names(made, "n", "at", names).select(readable.columns).collect())
    )
    assert readable.filter("current").groupBy("k").count().filter("count <> 1").count() == 0
    assert readable.columns == ["k", "v", "note", *names]


def test_current_value_is_the_last_version(spark):
    df = frame(spark, SCHEMA, *sample(4))
    now = history.latest_per_key(df, ["k"], "at")
    last = history.change_history(df, ["k"], "at", ["v"]).filter("__END_AT IS NULL").select(*df.columns)
    assert now.exceptAll(last).count() == 0 and last.exceptAll(now).count() == 0


def test_intervals_of_a_key_are_contiguous(spark):
    df = frame(spark, SCHEMA, *sample(5))
    by_key = {}
    for k, start, end, *_ in versions(df):
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1] is None


def test_current_value_keeps_one_row_per_task_before_the_shuffle(spark):
    plan = history.latest_per_key(frame(spark, SCHEMA, ("a", 1, 1, "x")), ["k"], "at")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_history_of_ordinary_keys_shuffles_once(spark):
    made = history.change_history(frame(spark, SCHEMA, ("a", 1, 1, "x")), ["k"], "at", ["v"])
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_revisions(spark):
    df = frame(spark, "k string, at timestamp, v double",
               ("a", "2026-01-01 00:00:00", 10), ("a", "2026-01-02 12:00:00", 10), ("a", "2026-01-03 00:00:00", 14))
    past = history.change_history(df, ["k"], "at", ["v"])
    (row,) = history.revisions(past, ["k"], "v").collect()
    assert (row["old_value"], row["new_value"], row["change"], row["delay_days"]) == (10, 14, 4, 2.0)
    (total,) = history.revision_summary(history.revisions(past, ["k"], "v"), ["k"]).collect()
    assert (total["revisions"], total["mean_change"]) == (1, 4)
    assert row["revised_at"] == dt.datetime(2026, 1, 3)
