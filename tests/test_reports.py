"""Business and monitoring datasets with hand-computed numbers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace.plans.energy import monitoring, reports
from tests.conftest import frame

D = dt.date
MONTHLY = "mes date, uf string, tipo_usina string, geracao_verificada_mwh double, capacidade_mwh double"
AUDIT = (
    "pipeline_name string, data_referencia string, execution_timestamp timestamp, status string, "
    "linhas_gravadas bigint, duracao_segundos double, erro string"
)
NOW = dt.datetime(2026, 10, 31, tzinfo=dt.timezone.utc)


def one(df):
    return df.first().asDict()


@pytest.fixture
def monthly(spark):
    return frame(
        spark, MONTHLY,
        ("2026-07-01", "BA", "Eólica", 30, 100), ("2026-10-01", "CE", "Eólica", 80, 100),
        ("2026-02-01", "BA", "Eólica", 20, 100), ("2026-07-01", "BA", "Solar", 99, 100),
    )


def test_headlines(spark, monthly):
    shortfall = frame(spark, "data date, restricao_mwh double", ("2026-07-01", 1.25e6), ("2026-07-02", 1e6))
    correlation = frame(spark, "variavel string, correlacao double", ("vento_100m_ms", 0.5), ("vento_100m_ms", 0.75), ("temperatura_c", 9))
    accuracy = frame(spark, "erro_medio_absoluto_vento_100m_kmh double", (4,), (5,))
    assert one(reports.headlines(monthly, shortfall, correlation, accuracy)) == {
        "fator_eolico_safra_pct": 55.0, "fator_eolico_entressafra_pct": 20.0, "restricao_twh": 2.3,
        "correlacao_vento": 0.63, "erro_previsao_vento_kmh": 4.5,
    }


def test_headlines_read_each_table_once(spark, monthly):
    other = frame(spark, "data date, restricao_mwh double, variavel string, correlacao double, erro_medio_absoluto_vento_100m_kmh double")
    plan = reports.headlines(monthly, other, other, other)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") and "Join" not in plan


def test_weighted_percentages(monthly):
    by_month = {(r["mes"], r["tipo_usina"]): r["fator_pct"] for r in reports.capacity_by_month(monthly).collect()}
    assert by_month[D(2026, 7, 1), "Solar"] == 99.0 and by_month[D(2026, 10, 1), "Eólica"] == 80.0
    by_state = {(r["uf"], r["tipo_usina"]): r["fator_pct"] for r in reports.capacity_by_state(monthly).collect()}
    assert by_state["BA", "Eólica"] == 25.0


def test_curves_need_enough_hours(spark):
    curve = frame(
        spark, "tipo_usina string, faixa_inicio double, fator_capacidade double, horas bigint",
        ("Eólica", 3, 0.1234, 100), ("Eólica", 4, 0.5, 99), ("Solar", 50, 0.2, 500),
    )
    assert [tuple(r) for r in reports.wind_curve(curve).collect()] == [(3.0, 12.3, 100)]
    assert [tuple(r) for r in reports.solar_curve(curve).collect()] == [(50.0, 20.0, 500)]


def test_main_correlations_are_relabelled(spark):
    correlation = frame(
        spark, "uf string, tipo_usina string, variavel string, correlacao double",
        ("BA", "Eólica", "vento_100m_ms", 0.616), ("BA", "Solar", "radiacao_solar_wm2", None), ("BA", "Solar", "temperatura_c", 1),
    )
    got = {(r["relacao"], r["correlacao"]) for r in reports.main_correlations(correlation).collect()}
    assert got == {("Eólica: vento a 100 m", 0.62), ("Solar: radiação", None)}


def test_shortfall_by_complete_month(spark):
    shortfall = frame(
        spark, "data date, previsto_mwh double, restricao_mwh double",
        ("2026-08-01", 1000, 400), ("2026-08-31", 1000, 200), ("2026-09-01", 5, 5),
    )
    (row,) = reports.shortfall_by_month(shortfall, F.lit(D(2026, 9, 15))).collect()
    assert tuple(row) == (D(2026, 8, 1), 1.0, 30.0)


def test_ten_most_limited_plants(spark):
    plants = frame(spark, "nome_usina string, restricao_mwh double", *[(f"P{i:02d}", i * 1000) for i in range(12)])
    got = reports.most_limited_plants(plants).collect()
    assert [r["nome_usina"] for r in got] == [f"P{i:02d}" for i in range(11, 1, -1)]
    assert got[0]["restricao_gwh"] == 11.0


def test_errors_and_scatter(spark):
    errors = frame(spark, "mes date, tipo_usina string, erro_absoluto_mwh double, geracao_verificada_mwh double",
                   ("2026-08-01", "Solar", 1, 10), ("2026-08-01", "Solar", 2, 10))
    assert one(reports.schedule_error_by_month(errors))["erro_pct"] == 15.0
    points = frame(spark, "ponto_id string, erro_medio_absoluto_vento_100m_kmh double, vento_100m_observado_kmh double",
                   ("p", 4, 30), ("p", 5, 31))
    assert one(reports.forecast_error_by_point(points)) == {"ponto_id": "p", "erro_vento_kmh": 4.5, "vento_medio_kmh": 30.5}
    days = frame(spark, "temperatura_media_c double, carga_mwmed double, fim_de_semana boolean", (28, 14321, True), (29, 15000, False))
    assert {tuple(r) for r in reports.load_and_heat(days).collect()} == {
        (28.0, 14.32, "Fim de semana"), (29.0, 15.0, "Dia útil"),
    }


@pytest.fixture
def audit(spark):
    return frame(
        spark, AUDIT,
        ("01", "2026-10-30", "2026-10-30 01:00:00", "success", 10, 1.5, None),
        ("01", "2026-10-30", "2026-10-30 02:00:00", "success", 5, 1.5, None),
        ("02", "2026-10-30", "2026-10-30 05:00:00", "failed", 0, 2.0, "boom"),
        ("02", "2026-08-01", "2026-08-01 05:00:00", "failed", 0, 2.0, "old"),
    )


def test_summary_counts_recent_runs_and_all_held_rows(spark, audit):
    held = [frame(spark, "a int", (1,), (2,)), frame(spark, "b string", ("x",)), frame(spark, "c int")]
    assert one(monitoring.summary(audit, held, F.lit(NOW))) == {
        "execucoes_ingestao": 3, "falhas_ingestao": 1, "registros_em_quarentena": 3,
    }


def test_rows_per_local_day(audit):
    got = {tuple(r) for r in monitoring.rows_per_day(audit, F.lit(NOW)).collect()}
    assert got == {(D(2026, 10, 29), "01", 15)}  # 01:00 and 02:00 UTC are the evening before


def test_latest_runs_first(audit):
    got = monitoring.latest_runs(audit).collect()
    assert [r["status"] for r in got] == ["failed", "success", "success", "failed"]
    assert got[0]["inicio_brasilia"] == dt.datetime(2026, 10, 30, 2)


def test_updates_and_rules_from_the_event_log(spark):
    log = spark.createDataFrame(
        [
            ("update_progress", ("u1",), dt.datetime(2026, 10, 30, 1), '{"update_progress": {"state": "RUNNING"}}'),
            ("update_progress", ("u1",), dt.datetime(2026, 10, 30, 1, 30), '{"update_progress": {"state": "COMPLETED"}}'),
            ("flow_progress", ("u1",), dt.datetime(2026, 10, 30, 1, 20),
             '{"flow_progress": {"data_quality": {"expectations": ['
             '{"name": "r", "dataset": "t_validada", "passed_records": 7, "failed_records": 1},'
             '{"name": "r", "dataset": "t_validada", "passed_records": 3, "failed_records": 0},'
             '{"name": "r", "dataset": "t", "passed_records": 99, "failed_records": 9}]}}}'),
            ("flow_progress", ("u1",), dt.datetime(2026, 10, 30, 1, 20), '{"flow_progress": {}}'),
        ],
        "event_type string, origin struct<update_id string>, timestamp timestamp, details string",
    )
    (run,) = monitoring.update_runs([monitoring.progress_from_log(log, "silver")], F.lit(NOW)).collect()
    assert tuple(run) == ("silver", dt.datetime(2026, 10, 29, 22), 30.0, "COMPLETED")
    (rule,) = monitoring.rule_totals(monitoring.counts_from_log(log)).collect()
    assert tuple(rule) == ("t", "r", 10, 1)
