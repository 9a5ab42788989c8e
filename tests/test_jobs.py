"""Published files and captured responses through raw, clean and metric tables to datasets."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from terrace.plans.energy import ingest, jobs, values
from terrace.plans.energy.metrics import METRIC_TABLES
from terrace.plans.runner import compute_metrics
from terrace.sources.sinks import read_raw
from terrace.streaming.apply import IncrementalTable
from tests.conftest import raw_rows, weather_json

D = dt.date


def publish(spark, landing, name, table, rows):
    raw_rows(spark, table, rows).drop("ingestion_timestamp").write.mode("overwrite").parquet(f"{landing}/{name}")


def capture(landing, folders, first_day, hours, suffix="", points=15):
    folder = landing.joinpath(*folders)
    folder.mkdir(parents=True)
    responses = [json.loads(weather_json(first_day, hours, suffix, base=10.0)) for _ in range(points)]
    (folder / "document.json").write_text(json.dumps(responses))


def same_rows(left, right):
    """Equal rows, numbers to nine digits: sums of parts may differ in the last bit."""
    shown = lambda df: sorted(str([f"{x:.9g}" if isinstance(x, float) else x for x in r]) for r in df.select(sorted(df.columns)).collect())
    return shown(left) == shown(right)


def test_chain(spark, tmp_path, monkeypatch):
    landing, raw, clean, metric = (str(tmp_path / n) for n in ("landing", "raw", "clean", "metric"))
    hours = [f"2026-09-01 {h:02d}:00:00" for h in range(3)]
    plants = [
        {"din_instante": h, "id_ons": f"{kind}-{u}", "id_subsistema": "NE", "id_estado": "BA", "nom_tipousina": kind,
         "val_geracaoprogramada": "10", "val_geracaoverificada": str(8 + i), "val_capacidadeinstalada": "20", "val_fatorcapacidade": 0.4}
        for kind in ("Eólica", "Solar") for u in (1, 2) for i, h in enumerate(hours)
    ]
    for month in ("08", "09"):
        publish(spark, landing, f"FATOR_CAPACIDADE-2_2026_{month}.parquet", "ons.fator_capacidade",
                [{**p, "din_instante": p["din_instante"].replace("-09-", f"-{month}-")} for p in plants])
    publish(spark, landing, "GERACAO_USINA-2_2026_09.parquet", "ons.geracao_usina",
            [{"din_instante": hours[0], "nom_usina": "A", "ceg": "-", "id_subsistema": "NE", "val_geracao": 1.0},
             {"din_instante": hours[0], "nom_usina": "B", "ceg": "-", "id_subsistema": "XX", "val_geracao": 1.0}])
    publish(spark, landing, "PROGRAMACAO_X_PREVISAO_2026_09_30.parquet", "ons.previsao_programado_eolsol",
            [{"dat_programacao": "20260930", "num_patamar": n, "cod_usinapdp": "U", "nom_usinapdp": "Um", "val_previsao": "10", "val_programado": "4"}
             for n in (1, 2)])
    load = [{"id_subsistema": "NE", "din_instante": f"2026-09-0{d}", "val_cargaenergiamwmed": 10000.0 + d} for d in (1, 2)]
    old = [{"id_subsistema": "NE", "din_instante": "2026-01-01", "val_cargaenergiamwmed": 1.0}]
    publish(spark, landing, "CARGA_ENERGIA_2026.parquet", "ons.carga_energia", load + old)
    capture(tmp_path / "landing", ("observado", "start_date=2026-09-01", "end_date=2026-09-02"), "2026-09-01", 48)
    capture(tmp_path / "landing", ("previsao", "data_referencia=2026-08-31", "data_prevista=2026-09-01", "horizonte_dias=1"), "2026-09-01", 24)
    capture(tmp_path / "landing", ("previsao_anterior", "start_date=2026-09-02", "end_date=2026-09-02", "horizonte_dias=1"),
            "2026-09-02", 24, "_previous_day1")

    assert ingest.load_months(spark, "capacidade", landing, raw, [D(2026, 9, 5), D(2026, 10, 5)]) == 24
    assert ingest.load_months(spark, "geracao", landing, raw, [D(2026, 10, 5)]) == 2
    assert ingest.load_schedule(spark, landing, raw, today=D(2026, 10, 1)) == 2
    assert ingest.load_demand(spark, landing, raw, D(2026, 10, 1)) == 2
    for feed in ("observado", "previsao", "previsao_anterior"):
        assert ingest.load_responses(spark, feed, landing, raw, D(2026, 10, 1)) == len(values.WEATHER_POINTS)
    with pytest.raises(Exception):
        ingest.load_months(spark, "geracao", landing, raw, [D(2020, 1, 5)])

    jobs.update_clean(spark, raw, clean)
    jobs.update_metrics(spark, clean, metric)
    tables = jobs.metric_tables(spark, metric)
    assert tables["aproveitamento_mensal"].count() == 4
    assert tables["clima_x_geracao_horaria"].count() == 6
    assert tables["precisao_previsao_tempo"].agg(F.sum("horas")).first()[0] == 48 * 15
    assert tables["carga_x_temperatura"].count() == 2
    assert tables["restricao_geracao_diaria"].first()["restricao_mwh"] == 6.0
    datasets = jobs.business_datasets(spark, metric, F.lit(D(2026, 11, 1)))
    assert datasets["restricao_usinas"].first()["nome_usina"] == "Um"
    assert datasets["destaques"].first()["fator_eolico_safra_pct"] == 45.0

    # A revision arrives: only the changed day gets a second version.
    publish(spark, landing, "CARGA_ENERGIA_2026.parquet", "ons.carga_energia", [load[0], {**load[1], "val_cargaenergiamwmed": 5.0}])
    ingest.load_demand(spark, landing, raw, D(2026, 10, 8))
    jobs.update_clean(spark, raw, clean)
    state = jobs.clean_state(clean, next(t for t in jobs.CLEAN_TABLES if t.name == "carga_energia"))
    assert sorted((r["data"].day, r["numero_versao"], r["versao_atual"]) for r in state.versions(spark).collect()) == [
        (1, 1, True), (2, 1, False), (2, 2, True),
    ]
    assert state.current(spark).filter("data = '2026-09-02'").first()["carga_mwmed"] == 5.0

    # The refresh reads only the month of the revision, and equals a computation from all rows.
    read = []
    keep = IncrementalTable._read
    monkeypatch.setattr(IncrementalTable, "_read", lambda self, spark, paths, cols: read.extend(paths) or keep(self, spark, paths, cols))
    published = jobs.update_metrics(spark, clean, metric)
    monkeypatch.undo()
    assert read and {p.split("state_part=")[1][:7] for p in read} == {"2026-09"}
    assert {p.removeprefix(clean).split("/")[1] for p in read} == {"carga_energia", "clima_observado"}
    states = {t.name: jobs.clean_state(clean, t) for t in jobs.CLEAN_TABLES}
    whole = compute_metrics(METRIC_TABLES, lambda name: states[name].current(spark))
    assert set(whole) == set(published) and len(whole) == 9
    for name, df in whole.items():
        assert same_rows(df, published[name]), name
    assert published["carga_x_temperatura"].filter("data = '2026-09-02'").first()["carga_mwmed"] == 5.0
    pointers = sorted(p.name for p in (tmp_path / "metric" / "aproveitamento_mensal" / "_published").iterdir() if not p.name.startswith("."))
    assert len(pointers) == 1  # nothing to do for a table whose inputs did not change

    now = F.lit(dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1))
    watch = jobs.monitoring_datasets(spark, raw, clean, now)
    assert watch["resumo"].first().asDict() == {
        "execucoes_ingestao": 9, "falhas_ingestao": 1, "registros_em_quarentena": 1,
    }
    assert watch["atualizacoes_pipelines"].filter("estado = 'COMPLETED'").count() == 4
    assert watch["qualidade"].filter("tabela = 'geracao_usina' AND regra = 'subsistema_conhecido'").first()["reprovados"] == 1
    assert read_raw(spark, ingest.raw_path(raw, "ons.carga_energia")).count() == 4
    jobs.export_metrics(spark, metric, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "aproveitamento_mensal")).count() == 4


def test_a_document_that_lacks_points_fails_and_is_audited(spark, tmp_path):
    capture(tmp_path / "landing", ("observado", "start_date=2026-09-01", "end_date=2026-09-01"), "2026-09-01", 1, points=14)
    raw = str(tmp_path / "raw")
    with pytest.raises(Exception, match="14 responses"):
        ingest.load_responses(spark, "observado", str(tmp_path / "landing"), raw, D(2026, 9, 2))
    assert spark.read.parquet(ingest.audit_path(raw)).first()["status"] == "failed"


def test_observation_window(spark):
    blocks = ingest.observed_periods(spark, D(2026, 10, 8)).orderBy("block_start").collect()
    assert [tuple(b) for b in blocks] == [(D(2026, 9, 22), D(2026, 9, 28))]


def test_backfill_over_a_change_of_type(spark, tmp_path):
    """A publisher wrote numbers as text first and as numbers since; one run loads both, upkeep reads the result."""
    landing, raw, clean = (str(tmp_path / n) for n in ("landing", "raw", "clean"))
    row = {"nom_usina": "A", "ceg": "c1", "id_subsistema": "NE", "id_estado": "BA", "nom_tipousina": "Eólica"}
    for month, value in ((4, "7.5"), (5, None), (6, 2.25)):
        day = f"2026-{month:02d}-10 00:00:00"
        frame = raw_rows(spark, "ons.geracao_usina", [{**row, "din_instante": day, "val_geracao": None}]).drop("ingestion_timestamp")
        typed = frame.withColumn("val_geracao", F.lit(value).cast("double" if month == 6 else "string"))
        typed.write.parquet(f"{landing}/GERACAO_USINA-2_2026_{month:02d}.parquet")
    assert ingest.load_months(spark, "geracao", landing, raw, [D(2026, 5, 1)]) == 1  # text alone comes first
    assert ingest.load_months(spark, "geracao", landing, raw, [D(2026, 6, 1), D(2026, 7, 1)]) == 2
    stored = read_raw(spark, ingest.raw_path(raw, "ons.geracao_usina"))
    assert dict(stored.dtypes)["val_geracao"] == "double"
    assert sorted(str(r.val_geracao) for r in stored.select("val_geracao").collect()) == ["2.25", "7.5", "None"]
    jobs.update_clean(spark, raw, clean)
