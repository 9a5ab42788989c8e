"""Scans, alignment, sinks, audit log, backfill periods."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from terrace.functions import dates
from terrace.sources import align, audit, backfill, scans, sinks
from tests.conftest import frame

AT = dt.datetime(2026, 10, 1, 12, tzinfo=dt.timezone.utc)
D = dt.date


def aligned(spark, *values):
    source = frame(spark, "usina string, val_geracao string", *[("U", v) for v in values])
    target = frame(spark, "usina string, val_geracao double").schema
    return [r["val_geracao"] for r in align.align_to_schema(source, target).collect()]


def test_text_that_is_a_number_converts_and_blank_is_null(spark):
    assert aligned(spark, "58.91700000", "0E-8", "-1.4155", "", "  ", None) == [58.917, 0.0, -1.4155, None, None, None]


@pytest.mark.parametrize("bad", ["12,5", "n/d", "abc"])
def test_any_other_loss_aborts_with_column_and_count(spark, bad):
    with pytest.raises(align.LossyConversion, match=r"'val_geracao': 2"):
        aligned(spark, "1.0", bad, bad)


def test_same_types_return_the_same_object_and_new_columns_pass(spark):
    df = frame(spark, "a string, b double", ("x", 1))
    assert align.align_to_schema(df, df.select("a").schema) is df


def test_append_counts_rows_and_accepts_new_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert sinks.append_raw(frame(spark, "u string, v double", ("a", 1), ("b", 2)), path, "src", AT) == 2
    assert sinks.append_raw(frame(spark, "u string, v string, w int", ("c", "3.5", 7)), path, "src", AT) == 1
    rows = {r["u"]: (r["v"], r["w"], r["source"], r["ingestion_timestamp"]) for r in sinks.read_raw(spark, path).collect()}
    assert rows["c"][:3] == (3.5, 7, "src") and rows["a"][:2] == (1.0, None)
    with pytest.raises(align.LossyConversion):
        sinks.append_raw(frame(spark, "u string, v string", ("d", "n/d")), path, "src", AT)
    assert sinks.read_raw(spark, path).count() == 3


def test_years_may_lack_only_the_current_file(spark, tmp_path):
    paths = {y: str(tmp_path / f"load_{y}") for y in (2024, 2025, 2026)}
    frame(spark, "a int, b int", (1, 2)).write.parquet(paths[2024])
    frame(spark, "b int, a int", (2, 1)).write.parquet(paths[2025])
    assert scans.read_years(spark, paths, 2026).select("a", "b").distinct().collect() == [(1, 2)]
    with pytest.raises(scans.SourceMissing, match="2026"):
        scans.read_years(spark, paths, 2025)
    with pytest.raises(scans.SourceMissing):
        scans.read_years(spark, {2026: paths[2026]}, 2026)


def test_responses_pair_with_points_by_position(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    points = frame(spark, "position int, ponto_id string", (0, "p0"), (1, "p1"))
    documents = scans.read_documents(spark, str(folder))
    rows = scans.responses_by_position(documents, "document", "file", points, "position", "raw")
    assert sorted((r["ponto_id"], r["raw"]) for r in rows.collect()) == [("p0", '{"x":1}'), ("p1", '{"x":2}')]
    single = documents.withColumn("document", F.lit('{"x": 9}'))
    one = scans.responses_by_position(single, "document", "file", points.filter("position = 0"), "position", "raw")
    assert [r["raw"] for r in one.collect()] == ['{"x": 9}']
    with pytest.raises(Exception, match="holds 2 responses"):
        scans.responses_by_position(documents, "document", "file", points.filter("position = 0"), "position", "raw").collect()


def test_audited_run_logs_success_and_failure(spark, tmp_path):
    log = str(tmp_path / "audit")
    with audit.audited_run(spark, log, "05", D(2026, 10, 1)) as run:
        run.rows = 7
    with pytest.raises(ValueError):
        with audit.audited_run(spark, log, "06", D(2026, 10, 1)):
            raise ValueError("x" * 5000)
    with pytest.raises(ValueError):
        with audit.audited_run(spark, log, "07", D(2026, 10, 1), most_error_chars=1000):
            raise ValueError("x" * 5000)
    rows = {r["pipeline_name"]: r for r in spark.read.parquet(log).collect()}
    assert (rows["05"]["status"], rows["05"]["linhas_gravadas"], rows["05"]["erro"]) == ("success", 7, None)
    assert rows["06"]["status"] == "failed" and rows["06"]["erro"] == repr(ValueError("x" * 5000))
    assert len(rows["07"]["erro"]) == 1000
    assert rows["05"]["data_referencia"] == "2026-10-01"


def test_snapshot_refresh_switches_at_once(spark, tmp_path):
    table = sinks.Snapshot(str(tmp_path / "gold"))
    assert table.refresh(frame(spark, "a int", (1,))).count() == 1
    old = table.read(spark)
    table.refresh(frame(spark, "a int", (2,), (3,)))
    assert sorted(r["a"] for r in table.read(spark).collect()) == [2, 3]
    assert [r["a"] for r in old.collect()] == [1]


def test_clone_once_and_reconcile(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    frame(spark, "a int", (1,), (2,)).write.parquet(source)
    assert sinks.clone_if_absent(spark, source, target)
    frame(spark, "a int", (3,)).write.mode("append").parquet(source)
    assert not sinks.clone_if_absent(spark, source, target)
    (row,) = sinks.reconcile_counts({"t": (spark.read.parquet(source), spark.read.parquet(target))}).collect()
    assert (row["source_rows"], row["target_rows"], row["equal"]) == (3, 2, False)


def test_export_csv(spark, tmp_path):
    sinks.export_csv(frame(spark, "a int, b string", (1, "x")), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).collect() == [("1", "x")]


@pytest.mark.parametrize(
    "first, last, blocks",
    [
        (D(2024, 1, 15), D(2024, 3, 1), [(D(2024, 1, 15), D(2024, 1, 31)), (D(2024, 2, 1), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 1))]),
        (D(2025, 12, 31), D(2026, 1, 1), [(D(2025, 12, 31), D(2025, 12, 31)), (D(2026, 1, 1), D(2026, 1, 1))]),
        (D(2026, 5, 3), D(2026, 5, 3), [(D(2026, 5, 3), D(2026, 5, 3))]),
        (D(2026, 5, 3), D(2026, 5, 2), []),
    ],
)
def test_month_blocks(spark, first, last, blocks):
    assert [tuple(r) for r in backfill.period_table(spark, first, last).orderBy("block_start").collect()] == blocks


def days_where(spark, condition, first="2026-07-01", last="2026-10-15"):
    days = spark.sql(f"SELECT explode(sequence(timestamp_ntz'{first}', timestamp_ntz'{last}', interval 12 hours)) AS t")
    return [r[0] for r in days.filter(condition("t")).select(F.to_date("t")).distinct().orderBy("to_date(t)").collect()]


def test_windows(spark):
    ref = D(2026, 10, 1)
    span = lambda got: (got[0], got[-1], len(got))
    assert span(days_where(spark, lambda c: dates.in_day_window(c, ref, 60))) == (D(2026, 8, 2), ref, 61)
    assert span(days_where(spark, lambda c: dates.in_day_window(c, ref, 16, 10))) == (D(2026, 9, 15), D(2026, 9, 21), 7)
    assert span(days_where(spark, lambda c: dates.in_closed_month(c, ref))) == (D(2026, 9, 1), D(2026, 9, 30), 30)
    assert days_where(spark, lambda c: dates.on_lagged_day(c, ref)) == [D(2026, 9, 30)]
    assert dates.years_between(D(2025, 12, 1), D(2026, 1, 3)) == [2025, 2026]


def test_backfill_selects_months_and_days(spark):
    months = backfill.closed_months_before([D(2026, 8, 5), D(2026, 9, 1), D(2026, 11, 1)])
    assert months == [D(2026, 7, 1), D(2026, 8, 1), D(2026, 10, 1)]
    got = days_where(spark, lambda c: backfill.in_months(c, months))
    assert len(got) == 31 + 31 + 15 and D(2026, 9, 1) not in got
    assert days_where(spark, lambda c: backfill.on_days(c, [D(2026, 8, 9)])) == [D(2026, 8, 9)]


def test_a_session_in_another_zone_is_refused(spark):
    from terrace.session import require_utc

    spark.conf.set("spark.sql.session.timeZone", "America/Fortaleza")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_alignment_refuses_what_casting_back_does_not_return(spark):
    from pyspark.sql import types as T

    whole = T.StructType().add("n", T.IntegerType())
    fits = spark.createDataFrame([(3.0,), (None,)], "n double")
    assert [r.n for r in align.align_to_schema(fits, whole).collect()] == [3, None]
    with pytest.raises(align.LossyConversion) as problem:
        align.align_to_schema(spark.createDataFrame([(1.9,), (2.0,)], "n double"), whole)
    assert problem.value.losses == {"n": 1}


def test_recode_join_keeps_the_number_of_rows(spark):
    from terrace.functions import text

    rows = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    names = spark.createDataFrame([("a", "x"), ("a", "w"), ("c", "z")], "k string, label string")
    got = text.recode_join(rows, "code", names, "k", "label", "name").collect()
    assert sorted((r.code or "", r.name) for r in got) == [("", None), ("a", "w"), ("b", None)]


def test_title_prefix_keeps_long_rests(spark):
    from terrace.functions import text

    long = "tipo " + "x" * 200
    got = spark.range(1).select(text.title_prefix(F.lit(long), "TIPO ", "Tipo ").alias("t")).first().t
    assert got == "Tipo " + "X" * 200


def test_refreshes_from_one_pointer_do_not_share_a_folder(spark, tmp_path):
    from terrace.sources.sinks import Snapshot

    table = Snapshot(str(tmp_path / "snap"))
    table.refresh(spark.range(7))
    before = table.live_path(spark)
    table.refresh(spark.range(9))
    assert table.live_path(spark) != before and spark.read.parquet(before).count() == 7 and table.read(spark).count() == 9
