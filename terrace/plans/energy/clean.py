"""Raw layouts of the grid and weather sources to clean columns, and the six clean tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import dates, numeric, text
from terrace.functions.columns import column_or_null, with_default
from terrace.operators.flatten import explode_series
from terrace.plans.energy import values as v
from terrace.plans.spec import SEQUENCE, CleanTable
from terrace.sources.sinks import INGESTED_AT


def _shape(raw: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    """Project the raw table onto clean columns, followed by the sequence."""
    return raw.select(
        *[value.alias(name) for name, value in mapping.items()], F.col(INGESTED_AT).alias(SEQUENCE)
    )


def subsystem(raw_code: str) -> dict[str, Column]:
    code = text.clean_code(raw_code)
    return {"id_subsistema": code, "subsistema": text.recode(code, v.SUBSYSTEMS)}


def plant_kind(raw_kind: str) -> Column:
    return text.recode(text.fold_accents(raw_kind, v.ACCENTED, v.PLAIN), v.PLANT_KINDS)


def operation_mode(raw_mode: str) -> Column:
    return text.title_prefix(raw_mode, v.MODE_PREFIX, v.MODE_SHOWN)


def registry_code(raw_code: str) -> Column:
    return text.clean_text(raw_code, placeholders=[v.NO_CODE])


def clean_load(raw: DataFrame) -> DataFrame:
    return _shape(
        raw,
        {
            **subsystem("id_subsistema"),
            "data": F.to_date("din_instante"),
            "carga_mwmed": F.col("val_cargaenergiamwmed").cast("double"),
        },
    )


def clean_generation(raw: DataFrame) -> DataFrame:
    return _shape(
        raw,
        {
            "data_hora": dates.wall_clock("din_instante"),
            "chave_usina": text.joined_key(
                "ceg", "nom_usina", separator=v.KEY_SEPARATOR, missing=[v.NO_CODE, None]
            ),
            "nome_usina": text.clean_text("nom_usina"),
            "ceg": registry_code("ceg"),
            "id_ons": registry_code("id_ons"),
            "tipo_usina": plant_kind("nom_tipousina"),
            "combustivel": text.clean_text("nom_tipocombustivel"),
            "modalidade_operacao": operation_mode("cod_modalidadeoperacao"),
            **subsystem("id_subsistema"),
            "uf": text.clean_code("id_estado"),
            "geracao_mwmed": F.col("val_geracao").cast("double"),
        },
    )


def clean_capacity(raw: DataFrame) -> DataFrame:
    measured = {
        "geracao_programada_mwmed": "val_geracaoprogramada",
        "geracao_verificada_mwmed": "val_geracaoverificada",
        "capacidade_instalada_mw": "val_capacidadeinstalada",
    }
    places = {
        "latitude_coletora": "val_latitudesecoletora",
        "longitude_coletora": "val_longitudesecoletora",
        "latitude_ponto_conexao": "val_latitudepontoconexao",
        "longitude_ponto_conexao": "val_longitudepontoconexao",
    }
    labels = {
        "codigo_ponto_conexao": "cod_pontoconexao",
        "nome_ponto_conexao": "nom_pontoconexao",
        "localizacao": "nom_localizacao",
    }
    return _shape(
        raw,
        {
            "data_hora": dates.wall_clock("din_instante"),
            "id_ons": registry_code("id_ons"),
            "nome_usina": text.clean_text("nom_usina_conjunto"),
            "ceg": registry_code("ceg"),
            "tipo_usina": plant_kind("nom_tipousina"),
            "modalidade_operacao": operation_mode("nom_modalidadeoperacao"),
            **subsystem("id_subsistema"),
            "uf": text.clean_code("id_estado"),
            **{name: text.clean_text(source) for name, source in labels.items()},
            **{name: F.col(source).cast("double") for name, source in places.items()},
            **{name: dates.to_number(source) for name, source in measured.items()},
            "fator_capacidade": F.col("val_fatorcapacidade").cast("double"),
        },
    )


def clean_schedule(raw: DataFrame) -> DataFrame:
    day, slot = dates.parse_day("dat_programacao"), F.col("num_patamar").cast("int")
    return _shape(
        raw,
        {
            "data": day,
            "patamar": slot,
            "inicio_patamar": dates.slot_start(day, slot, v.SLOT_MINUTES),
            "codigo_usina": text.clean_text("cod_usinapdp"),
            "nome_usina": text.clean_text("nom_usinapdp"),
            "previsao_mwmed": dates.to_number("val_previsao"),
            "programado_mwmed": dates.to_number("val_programado"),
        },
    )


_CONVERSIONS = {"boolean": numeric.flag, "int": lambda c: c.cast("int"), "double": lambda c: c}


def _hours(raw: DataFrame, context: dict[str, Column], suffix: str = "") -> DataFrame:
    """Weather responses by the hour; rows of layouts without a point get the legacy one."""
    point = {
        column.name: with_default(column_or_null(raw, column.name, "string"), default)
        for column, default in zip(v.POINT_COLUMNS, v.LEGACY_POINT, strict=True)
    }
    carried = {**point, **context, SEQUENCE: F.col(INGESTED_AT)}
    return explode_series(
        raw,
        "raw_response",
        [value.alias(name) for name, value in carried.items()],
        {api: _CONVERSIONS[kind] for api, _, kind, _ in v.WEATHER_VARIABLES},
        {api: column for api, column, _, _ in v.WEATHER_VARIABLES},
        suffix=suffix,
        hour="data_hora",
        scalars={"latitude": "latitude_grade", "longitude": "longitude_grade"},
    )


def clean_forecast(daily: DataFrame, previous_runs: DataFrame) -> DataFrame:
    """Daily captures, and back-filled forecasts whose issue day follows from each hour."""
    order = [*[c.name for c in v.FORECAST_COLUMNS], SEQUENCE]
    issued = F.try_to_date(F.col("data_referencia"))
    captured = _hours(
        daily,
        {
            "data_emissao": issued,
            "data_prevista": F.coalesce(F.try_to_date(column_or_null(daily, "data_prevista", "string")), issued),
            "horizonte_dias": with_default(column_or_null(daily, "horizonte_dias", "int").cast("int"), 0),
            "origem": F.lit(v.DAILY_ORIGIN),
        },
    )
    described = F.to_date("data_hora")
    backfilled = _hours(previous_runs, {}, suffix=f"_previous_day{v.PREVIOUS_HORIZON}").withColumns(
        {
            "data_emissao": dates.issue_day(described, v.PREVIOUS_HORIZON),
            "data_prevista": described,
            "horizonte_dias": F.lit(v.PREVIOUS_HORIZON),
            "origem": F.lit(v.PREVIOUS_ORIGIN),
        }
    )
    return reduce(DataFrame.unionByName, [part.select(*order) for part in (captured, backfilled)])


def clean_observed(raw: DataFrame) -> DataFrame:
    return _hours(raw, {}).select(*[c.name for c in v.OBSERVED_COLUMNS], SEQUENCE)


LOAD = CleanTable(
    name="carga_energia",
    source="ons",
    description="Daily load by subsystem",
    raw_tables=("ons.carga_energia",),
    standardize=clean_load,
    columns=v.LOAD_COLUMNS,
    key=("id_subsistema", "data"),
    drop_rules=v.LOAD_DROP,
    warn_rules=v.LOAD_WARN,
    versioned=("carga_mwmed",),
    month_column="data",
)
GENERATION = CleanTable(
    name="geracao_usina",
    source="ons",
    description="Hourly generation by plant",
    raw_tables=("ons.geracao_usina",),
    standardize=clean_generation,
    columns=v.GENERATION_COLUMNS,
    key=("data_hora", "chave_usina"),
    drop_rules=v.GENERATION_DROP,
    warn_rules=v.GENERATION_WARN,
    versioned=("geracao_mwmed",),
    month_column="data_hora",
)
CAPACITY = CleanTable(
    name="fator_capacidade",
    source="ons",
    description="Hourly capacity factor of wind and solar plants",
    raw_tables=("ons.fator_capacidade",),
    standardize=clean_capacity,
    columns=v.CAPACITY_COLUMNS,
    key=("data_hora", "id_ons"),
    drop_rules=v.CAPACITY_DROP,
    warn_rules=v.CAPACITY_WARN,
    versioned=(
        "geracao_programada_mwmed",
        "geracao_verificada_mwmed",
        "capacidade_instalada_mw",
        "fator_capacidade",
    ),
    month_column="data_hora",
)
SCHEDULE = CleanTable(
    name="previsao_programado",
    source="ons",
    description="Forecast and scheduled generation by plant and half hour",
    raw_tables=("ons.previsao_programado_eolsol",),
    standardize=clean_schedule,
    columns=v.SCHEDULE_COLUMNS,
    key=("data", "patamar", "codigo_usina"),
    drop_rules=v.SCHEDULE_DROP,
    warn_rules=v.SCHEDULE_WARN,
    versioned=("previsao_mwmed", "programado_mwmed"),
    month_column="data",
)
FORECAST = CleanTable(
    name="clima_previsao",
    source="open_meteo",
    description="Hourly weather forecast by point and issue day",
    raw_tables=("open_meteo.previsao_bruta", "open_meteo.previsao_historica_bruta"),
    standardize=clean_forecast,
    columns=v.FORECAST_COLUMNS,
    key=("ponto_id", "data_emissao", "data_hora"),
    drop_rules=v.FORECAST_DROP,
    warn_rules=v.WEATHER_WARN,
    month_column="data_hora",
)
OBSERVED = CleanTable(
    name="clima_observado",
    source="open_meteo",
    description="Observed hourly weather by point",
    raw_tables=("open_meteo.historico_observado",),
    standardize=clean_observed,
    columns=v.OBSERVED_COLUMNS,
    key=("ponto_id", "data_hora"),
    drop_rules=v.WEATHER_DROP,
    warn_rules=v.WEATHER_WARN,
    month_column="data_hora",
)

CLEAN_TABLES = (LOAD, GENERATION, CAPACITY, SCHEDULE, FORECAST, OBSERVED)
