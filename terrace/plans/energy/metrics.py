"""The nine metric tables, as configurations of the metric operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import dates, numeric, text
from terrace.operators import metrics as m
from terrace.plans.energy import values as v
from terrace.plans.spec import MetricTable, names_of


def in_scope(df: DataFrame) -> DataFrame:
    """Wind and solar plants of the analysed subsystem."""
    return df.filter(F.col("tipo_usina").isin(*v.RENEWABLES) & (F.col("id_subsistema") == v.ANALYSED_SUBSYSTEM))


_BY_MONTH_STATE_KIND = {"uf": "uf", "tipo_usina": "tipo_usina"}


def _month_groups() -> dict[str, Column | str]:
    return {"mes": dates.month_start("data_hora"), **_BY_MONTH_STATE_KIND}


def monthly_capacity_factor(capacity: DataFrame) -> DataFrame:
    # Hourly mean power summed over the hours is energy.
    return m.grouped_sums(
        in_scope(capacity),
        _month_groups(),
        {
            "geracao_verificada_mwh": "geracao_verificada_mwmed",
            "geracao_programada_mwh": "geracao_programada_mwmed",
            "capacidade_mwh": "capacidade_instalada_mw",
        },
        distinct={"usinas": "id_ons"},
        ratios={
            "fator_capacidade": ("geracao_verificada_mwh", "capacidade_mwh"),
            "fator_capacidade_programado": ("geracao_programada_mwh", "capacidade_mwh"),
        },
    )


def daily_shortfall(schedule: DataFrame) -> DataFrame:
    gap = F.col("previsao_mwmed") - F.col("programado_mwmed")
    return m.grouped_sums(
        schedule,
        {"data": "data"},
        {
            "previsto_mwh": "previsao_mwmed",
            "programado_mwh": "programado_mwmed",
            "restricao_mwh": numeric.shortfall("previsao_mwmed", "programado_mwmed"),
        },
        scale=v.SLOT_HOURS,
        distinct={"usinas": "codigo_usina"},
        others={
            "meias_horas_com_restricao_pct": F.avg(numeric.exceeds(gap, v.SHORTFALL_TOLERANCE_MW))
        },
        ratios={"restricao_pct": ("restricao_mwh", "previsto_mwh")},
    ).select(*names_of(v.DAILY_SHORTFALL_COLUMNS))


def plant_shortfall(schedule: DataFrame) -> DataFrame:
    return m.labelled_sums(
        schedule,
        {"mes": dates.month_start("data"), "codigo_usina": "codigo_usina"},
        ("nome_usina", "nome_usina"),
        {
            "previsto_mwh": "previsao_mwmed",
            "restricao_mwh": numeric.shortfall("previsao_mwmed", "programado_mwmed"),
        },
        scale=v.SLOT_HOURS,
        ratios={"restricao_pct": ("restricao_mwh", "previsto_mwh")},
    ).select(*names_of(v.PLANT_SHORTFALL_COLUMNS))


def schedule_error(capacity: DataFrame) -> DataFrame:
    totals = m.grouped_sums(
        in_scope(capacity),
        _month_groups(),
        {
            "geracao_programada_mwh": "geracao_programada_mwmed",
            "geracao_verificada_mwh": "geracao_verificada_mwmed",
            "erro_absoluto_mwh": numeric.absolute_error("geracao_programada_mwmed", "geracao_verificada_mwmed"),
        },
        ratios={"erro_relativo": ("erro_absoluto_mwh", "geracao_verificada_mwh")},
    )
    return totals.withColumn(
        "vies_relativo", numeric.relative_change("geracao_verificada_mwh", "geracao_programada_mwh")
    )


def weather_and_generation(capacity: DataFrame, observed: DataFrame) -> DataFrame:
    """Generation is summed to state and kind first, so the join meets one row per key."""
    hourly = m.grouped_sums(
        in_scope(capacity),
        {"data_hora": "data_hora", **_BY_MONTH_STATE_KIND},
        {
            "geracao_verificada_mwmed": "geracao_verificada_mwmed",
            "capacidade_mw": "capacidade_instalada_mw",
        },
        ratios={"fator_capacidade": ("geracao_verificada_mwmed", "capacidade_mw")},
    ).withColumn("ponto_id", text.slug_key("uf", "tipo_usina", v.POINT_SLUG, v.POINT_SLUG_OTHER))
    weather = observed.select(
        "ponto_id",
        "data_hora",
        (F.col("vento_velocidade_100m_kmh") / v.KMH_PER_MS).alias("vento_100m_ms"),
        "radiacao_solar_wm2",
        "cobertura_nuvens_pct",
        "temperatura_c",
        "precipitacao_mm",
    )
    return m.matched(hourly, weather, ["ponto_id", "data_hora"]).select(*names_of(v.WEATHER_GENERATION_COLUMNS))


def _by_kind(wind: Column | str, solar: Column | str) -> Column:
    return F.when(F.col("tipo_usina") == v.WIND, wind).otherwise(solar)


def power_curve(weather_generation: DataFrame) -> DataFrame:
    wind, solar = v.CURVE_VARIABLE[v.WIND], v.CURVE_VARIABLE[v.SOLAR]
    labelled = weather_generation.withColumn("variavel", _by_kind(wind, solar))
    return m.response_curve(
        labelled,
        ["tipo_usina", "variavel"],
        _by_kind(F.col(wind), F.col(solar)),
        _by_kind(F.lit(v.BIN_WIDTH[wind]), F.lit(v.BIN_WIDTH[solar])),
        "geracao_verificada_mwmed",
        "capacidade_mw",
        "fator_capacidade",
        names_of(v.POWER_CURVE_COLUMNS)[2:],
    )


def weather_correlation(weather_generation: DataFrame) -> DataFrame:
    """Solar plants use sunny hours only; otherwise day and night decide the result."""
    sunny = F.col("radiacao_solar_wm2") > 0
    kind = F.col("tipo_usina")
    pairs = [
        ((kind == which) & sunny if which == v.SOLAR else kind == which, variable)
        for which, variable in v.CORRELATED
    ]
    return m.correlations(
        weather_generation,
        ["uf", "tipo_usina"],
        [(F.coalesce(applies, F.lit(False)), variable) for applies, variable in pairs],
        "fator_capacidade",
        ["variavel", "correlacao", "horas"],
    )


def weather_accuracy(forecast: DataFrame, observed: DataFrame) -> DataFrame:
    measures = {"vento": "vento_velocidade_100m_kmh", "radiacao": "radiacao_solar_wm2", "temperatura": "temperatura_c"}

    def side(df: DataFrame, extra: list[str], mark: str) -> DataFrame:
        return df.select(*extra, *[F.col(source).alias(f"{name}_{mark}") for name, source in measures.items()])

    paired = m.matched(
        side(forecast.filter(F.col("horizonte_dias") == 1), ["ponto_id", "uf", "tipo_ponto", "data_hora"], "previsto"),
        side(observed, ["ponto_id", "data_hora"], "observado"),
        ["ponto_id", "data_hora"],
    )
    sunny = F.col("radiacao_observado") > 0
    wind_mae, wind_bias = m.mean_errors(F.col("vento_previsto"), F.col("vento_observado"))
    sun_mae, sun_bias = m.mean_errors(
        numeric.only_if(sunny, "radiacao_previsto"), numeric.only_if(sunny, "radiacao_observado")
    )
    heat_mae, _ = m.mean_errors(F.col("temperatura_previsto"), F.col("temperatura_observado"))
    aggregates = {
        "horas": F.count("*"),
        "vento_100m_observado_kmh": F.avg("vento_observado"),
        "erro_medio_absoluto_vento_100m_kmh": wind_mae,
        "vies_vento_100m_kmh": wind_bias,
        "radiacao_observada_wm2": F.avg(numeric.only_if(sunny, "radiacao_observado")),
        "erro_medio_absoluto_radiacao_wm2": sun_mae,
        "vies_radiacao_wm2": sun_bias,
        "erro_medio_absoluto_temperatura_c": heat_mae,
    }
    groups = {"mes": dates.month_start("data_hora"), **{c.name: c.name for c in v.POINT_COLUMNS}}
    return paired.groupBy(*m.named(groups)).agg(*m.named(aggregates))


def load_and_temperature(load: DataFrame, observed: DataFrame) -> DataFrame:
    heat = (
        observed.filter(F.col("tipo_ponto") == v.CITY_POINT)
        .groupBy(F.to_date("data_hora").alias("data"))
        .agg(
            F.avg("temperatura_c").alias("temperatura_media_c"),
            F.max("temperatura_c").alias("temperatura_maxima_c"),
        )
    )
    demand = load.filter(F.col("id_subsistema") == v.ANALYSED_SUBSYSTEM).select("data", "carga_mwmed")
    return m.matched(demand, heat, ["data"]).withColumns(
        {"dia_semana": dates.iso_weekday("data"), "fim_de_semana": dates.is_weekend("data")}
    )


METRIC_TABLES = (
    MetricTable(
        name="aproveitamento_mensal",
        question="How much of the installed capacity becomes energy over the year?",
        description="Monthly capacity factor by state and kind",
        compute=monthly_capacity_factor,
        columns=v.MONTHLY_CAPACITY_COLUMNS,
        clean_inputs=("fator_capacidade",),
        month_column="mes",
    ),
    MetricTable(
        name="restricao_geracao_diaria",
        question="How much of the forecast generation was not scheduled?",
        description="Forecast against scheduled generation by day",
        compute=daily_shortfall,
        columns=v.DAILY_SHORTFALL_COLUMNS,
        clean_inputs=("previsao_programado",),
        month_column="data",
    ),
    MetricTable(
        name="restricao_geracao_por_usina",
        question="Which plants had most generation forecast and not scheduled?",
        description="Forecast against scheduled generation by plant and month",
        compute=plant_shortfall,
        columns=v.PLANT_SHORTFALL_COLUMNS,
        clean_inputs=("previsao_programado",),
        month_column="mes",
    ),
    MetricTable(
        name="precisao_programacao_mensal",
        question="How far is actual generation from the schedule?",
        description="Error and bias of the schedule by month, state and kind",
        compute=schedule_error,
        columns=v.SCHEDULE_ERROR_COLUMNS,
        clean_inputs=("fator_capacidade",),
        month_column="mes",
    ),
    MetricTable(
        name="clima_x_geracao_horaria",
        question="Does the weather at the plants explain their generation?",
        description="Hourly capacity factor by state and kind with the weather at its point",
        compute=weather_and_generation,
        columns=v.WEATHER_GENERATION_COLUMNS,
        clean_inputs=("fator_capacidade", "clima_observado"),
        month_column="data_hora",
    ),
    MetricTable(
        name="curva_de_potencia",
        question="How does the capacity factor respond to wind and radiation?",
        description="Capacity factor by bin of wind speed or radiation",
        compute=power_curve,
        columns=v.POWER_CURVE_COLUMNS,
        metric_inputs=("clima_x_geracao_horaria",),
    ),
    MetricTable(
        name="correlacao_clima_geracao",
        question="How strongly does each weather variable relate to generation?",
        description="Correlation of weather with the capacity factor by state and kind",
        compute=weather_correlation,
        columns=v.CORRELATION_COLUMNS,
        metric_inputs=("clima_x_geracao_horaria",),
    ),
    MetricTable(
        name="precisao_previsao_tempo",
        question="How accurate is the day-ahead weather forecast?",
        description="Day-ahead forecast error by month and point",
        compute=weather_accuracy,
        columns=v.WEATHER_ACCURACY_COLUMNS,
        clean_inputs=("clima_previsao", "clima_observado"),
        month_column="mes",
    ),
    MetricTable(
        name="carga_x_temperatura",
        question="Does load rise on hot days?",
        description="Daily load with the temperature of the capitals and the weekday",
        compute=load_and_temperature,
        columns=v.LOAD_TEMPERATURE_COLUMNS,
        clean_inputs=("carga_energia", "clima_observado"),
        month_column="data",
    ),
)
