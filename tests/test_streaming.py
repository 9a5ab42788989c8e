"""Incremental upkeep equals the batch definition for any split and order of the input."""

import random

import pytest

from terrace.plans.energy import clean
from terrace.plans.runner import clean_batch
from terrace.sources.scans import read_stream
from terrace.streaming.apply import CheckpointLost, IncrementalTable
from tests.conftest import raw_rows, weather_json

RAW = "ons.carga_energia"


def load_rows(seed, size=120):
    dice = random.Random(seed)
    return [
        {
            "id_subsistema": dice.choice(["NE", "SE", "XX", None]),
            "din_instante": f"2026-{dice.choice(['08', '09'])}-0{dice.randrange(1, 4)} 00:00:00",
            "val_cargaenergiamwmed": dice.choice([1.0, 2.0, 3.0, None]),
            "ingestion_timestamp": f"2026-10-01 00:00:{n % 60:02d}",
        }
        for n in range(size)
    ]


def same(left, right):
    right = right.select(*left.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def check_against_batch(spark, state, raw):
    made = clean_batch(spark, clean.LOAD, raw)
    same(state.current(spark), made["carga_energia"])
    same(state.history(spark), made["carga_energia_historico_cdc"])
    same(state.versions(spark), made["carga_energia_versoes"])
    same(state.quarantine(spark), made["carga_energia_quarentena"])
    totals = state.rule_counts(spark).groupBy("table", "rule", "kind").sum("passed", "failed")
    same(totals.toDF("table", "rule", "kind", "passed", "failed"), made["carga_energia_regras"])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_order_equals_batch(spark, tmp_path, seed):
    rows = load_rows(seed)
    random.Random(seed).shuffle(rows)
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"), buckets=2)
    for number, start in enumerate(range(0, len(rows), 50)):
        batch = clean.clean_load(raw_rows(spark, RAW, rows[start : start + 50]))
        state.apply(batch, number)
        state.apply(batch, number)  # a replay changes nothing
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))


def test_unfinished_batch_is_invisible_and_its_retry_counts_once(spark, tmp_path, monkeypatch):
    rows = load_rows(3, 60)
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"))
    state.apply(clean.clean_load(raw_rows(spark, RAW, rows[:30])), 0)
    before = sorted(map(str, state.current(spark).collect()))
    rebuild = IncrementalTable._rebuild
    monkeypatch.setattr(IncrementalTable, "_rebuild", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        state.apply(clean.clean_load(raw_rows(spark, RAW, rows[30:])), 1)
    assert sorted(map(str, state.current(spark).collect())) == before
    monkeypatch.setattr(IncrementalTable, "_rebuild", rebuild)
    state.apply(clean.clean_load(raw_rows(spark, RAW, rows[30:])), 1)
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))


def test_a_batch_reads_and_writes_only_the_parts_it_touches(spark, tmp_path, monkeypatch):
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"), buckets=5)
    rows = [{**r, "id_subsistema": k} for k in ("NE", "SE", "S", "N") for r in load_rows(7, 40)]
    state.apply(clean.clean_load(raw_rows(spark, RAW, rows)), 0)
    sizes = []
    for number in range(1, 4):
        one = {**rows[0], "din_instante": "2026-08-02 00:00:00", "val_cargaenergiamwmed": 7.0 + number, "ingestion_timestamp": f"2026-10-02 00:00:0{number}"}
        rows.append(one)
        read = []
        keep = IncrementalTable._read
        monkeypatch.setattr(IncrementalTable, "_read", lambda self, spark, paths, cols, keep=keep, read=read: read.extend(paths) or keep(self, spark, paths, cols))
        state.apply(clean.clean_load(raw_rows(spark, RAW, [one])), number)
        monkeypatch.undo()
        stored = [p for p in read if "/state_part=" in p and "/staged/" not in p]
        assert len(stored) == 1 and stored[0].endswith("/state_part=" + stored[0].rsplit("=", 1)[1])
        written = [f.name for f in (tmp_path / "state" / "generation=000000" / "state" / f"batch={number}").iterdir() if f.name.startswith("state_part=")]
        assert written == [stored[0].rsplit("/", 1)[1]]
        sizes.append((tmp_path / "state" / "generation=000000" / "_manifest" / f"{number:012d}").stat().st_size)
    assert max(sizes) == min(sizes)  # the manifest does not grow with batches
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))
    with pytest.raises(ValueError, match="buckets"):
        IncrementalTable(clean.LOAD, str(tmp_path / "state"), buckets=3).apply(clean.clean_load(raw_rows(spark, RAW, rows)), 9)


def test_copies_of_an_instant_are_stored_once(spark, tmp_path):
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"))
    rows = load_rows(8, 30)
    for number in range(3):
        state.apply(clean.clean_load(raw_rows(spark, RAW, rows)), number)
    folders = [p for p in (tmp_path / "state" / "generation=000000" / "state" / "batch=2").iterdir() if p.name.startswith("state_part=")]
    held = spark.read.option("recursiveFileLookup", "true").parquet(*map(str, folders))
    assert held.count() == held.select(*clean.LOAD.key, "ingerido_em").distinct().count() < 30
    check_against_batch(spark, state, raw_rows(spark, RAW, rows * 3))


def test_stream_reads_only_new_files_and_refresh_rebuilds(spark, tmp_path):
    landing, rows = str(tmp_path / "raw"), load_rows(4, 90)
    raw_rows(spark, RAW, rows[:60]).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"))
    state.run_available(spark, read_stream(spark, landing, schema, maxFilesPerTrigger="1"))
    check_against_batch(spark, state, raw_rows(spark, RAW, rows[:60]))
    raw_rows(spark, RAW, rows[60:]).write.mode("append").parquet(landing)
    state.run_available(spark, read_stream(spark, landing, schema))
    state.run_available(spark, read_stream(spark, landing, schema))
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))
    incremental = sorted(map(str, state.history(spark).collect()))
    state.full_refresh(spark, read_stream(spark, landing, schema))
    assert sorted(map(str, state.history(spark).collect())) == incremental


def test_two_streams_feed_one_table_without_history(spark, tmp_path):
    daily = {
        "ponto_id": "p", "uf": "BA", "tipo_ponto": "eolica", "data_referencia": "2026-09-28",
        "data_prevista": "2026-09-29", "horizonte_dias": 1, "raw_response": weather_json("2026-09-29", 3),
        "ingestion_timestamp": "2026-10-01",
    }
    broken = {**daily, "raw_response": "{"}
    previous = {**daily, "raw_response": weather_json("2026-09-20", 2, "_previous_day1")}
    sources = {"open_meteo.previsao_bruta": [daily, broken], "open_meteo.previsao_historica_bruta": [previous]}
    streams = []
    for name, rows in sources.items():
        path = str(tmp_path / name)
        raw_rows(spark, name, rows).write.parquet(path)
        streams.append(read_stream(spark, path, spark.read.parquet(path).schema))
    state = IncrementalTable(clean.FORECAST, str(tmp_path / "state"))
    state.run_available(spark, *streams)
    assert state.current(spark).groupBy("origem").count().count() == 2
    assert state.current(spark).count() == 5
    assert state.quarantine(spark).count() == 1
    assert state.history(spark).count() == 0


def test_a_lost_checkpoint_is_an_error_not_a_silent_skip(spark, tmp_path):
    landing = str(tmp_path / "raw")
    raw_rows(spark, RAW, load_rows(5, 20)).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"))
    state.apply(clean.clean_load(raw_rows(spark, RAW, load_rows(6, 5))), 0)
    with pytest.raises(CheckpointLost):
        state.run_available(spark, read_stream(spark, landing, schema))
    state.full_refresh(spark, read_stream(spark, landing, schema))
    check_against_batch(spark, state, raw_rows(spark, RAW, load_rows(5, 20)))


def test_a_refresh_that_dies_leaves_the_live_table_and_is_not_continued(spark, tmp_path, monkeypatch):
    landing, rows = str(tmp_path / "raw"), load_rows(8, 40)
    raw_rows(spark, RAW, rows).repartition(4).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream = lambda: read_stream(spark, landing, schema, maxFilesPerTrigger="2")
    state = IncrementalTable(clean.LOAD, str(tmp_path / "state"))
    state.run_available(spark, stream())
    live, whole = state._generation(spark), IncrementalTable._apply

    def dying(self, batch, batch_id, base):
        if batch_id > 0:
            raise RuntimeError("executor host gone")
        whole(self, batch, batch_id, base)

    monkeypatch.setattr(IncrementalTable, "_apply", dying)
    with pytest.raises(Exception, match="executor host gone"):
        state.full_refresh(spark, stream())
    monkeypatch.undo()
    assert state._generation(spark) == live
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))
    state.full_refresh(spark, stream())
    assert state._generation(spark) != live
    check_against_batch(spark, state, raw_rows(spark, RAW, rows))
