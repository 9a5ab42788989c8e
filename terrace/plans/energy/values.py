"""Fixed values of the energy tables: names, vocabularies, rules and constants.

Column, table and rule names are the data contract readers query by; the words
and limits decide results. They are stated here once, as plain data.
"""

from terrace.plans.spec import columns

# Grid subsystem codes and names.
SUBSYSTEMS = {
    "N": "Norte",
    "NE": "Nordeste",
    "S": "Sul",
    "SE": "Sudeste/Centro-Oeste",
}

# Plant kinds, spelled without accents in upper case -> uniform name.
WIND, SOLAR = "Eólica", "Solar"
PLANT_KINDS = {
    "HIDROELETRICA": "Hidrelétrica",
    "HIDRELETRICA": "Hidrelétrica",
    "TERMICA": "Térmica",
    "EOLIELETRICA": "Eólica",
    "EOLICA": "Eólica",
    "FOTOVOLTAICA": "Solar",
    "SOLAR": "Solar",
    "NUCLEAR": "Nuclear",
}

# Accented capitals and their plain forms.
ACCENTED = "ÁÀÂÃÉÈÊÍÌÎÓÒÔÕÚÙÛÇ"
PLAIN = "AAAAEEEIIIOOOOUUUC"

# Absence marker, key separator, casing of operation modes.
NO_CODE = "-"
KEY_SEPARATOR = " | "
MODE_PREFIX, MODE_SHOWN = "TIPO ", "Tipo "

# Scope of the analysis and physical constants.
ANALYSED_SUBSYSTEM = "NE"
RENEWABLES = (WIND, SOLAR)
SLOT_MINUTES = 30
SLOT_HOURS = 0.5
SHORTFALL_TOLERANCE_MW = 0.5
KMH_PER_MS = 3.6
BIN_WIDTH = {"vento_100m_ms": 1.0, "radiacao_solar_wm2": 50.0}
CURVE_VARIABLE = {WIND: "vento_100m_ms", SOLAR: "radiacao_solar_wm2"}
POINT_SLUG = {WIND: "eolica"}
POINT_SLUG_OTHER = "solar"
CITY_POINT = "capital"
CORRELATED = (
    (WIND, "vento_100m_ms"),
    (WIND, "temperatura_c"),
    (SOLAR, "radiacao_solar_wm2"),
    (SOLAR, "cobertura_nuvens_pct"),
    (SOLAR, "temperatura_c"),
)

# Forecast origins, horizon of the back-filled ones, point of rows that name none.
DAILY_ORIGIN, PREVIOUS_ORIGIN = "coleta_diaria", "previsoes_anteriores"
PREVIOUS_HORIZON = 1
LEGACY_POINT = ("fortaleza", "CE", "capital")

# Weather points (id, state, kind, latitude, longitude).
WEATHER_POINTS = (
    ("ba-eolica", "BA", "eolica", -11.644, -41.736),
    ("rn-eolica", "RN", "eolica", -5.561, -36.232),
    ("pi-eolica", "PI", "eolica", -8.308, -41.149),
    ("ce-eolica", "CE", "eolica", -3.607, -39.245),
    ("pb-eolica", "PB", "eolica", -6.968, -36.830),
    ("pe-eolica", "PE", "eolica", -8.885, -37.045),
    ("ba-solar", "BA", "solar", -11.264, -42.279),
    ("pi-solar", "PI", "solar", -8.011, -43.623),
    ("ce-solar", "CE", "solar", -5.352, -38.514),
    ("rn-solar", "RN", "solar", -5.475, -37.008),
    ("pe-solar", "PE", "solar", -8.069, -38.483),
    ("pb-solar", "PB", "solar", -6.918, -37.343),
    ("fortaleza", "CE", "capital", -3.720, -38.540),
    ("recife", "PE", "capital", -8.050, -34.900),
    ("salvador", "BA", "capital", -12.970, -38.500),
)

# Hourly variables of a weather response: API name, column, type.
WEATHER_VARIABLES = (
    ("temperature_2m", "temperatura_c", "double", "Air temperature at 2 m, °C"),
    ("apparent_temperature", "sensacao_termica_c", "double", "Apparent temperature, °C"),
    ("relative_humidity_2m", "umidade_relativa_pct", "double", "Relative humidity at 2 m, %"),
    ("dew_point_2m", "ponto_orvalho_c", "double", "Dew point at 2 m, °C"),
    ("precipitation", "precipitacao_mm", "double", "Precipitation of the hour, mm"),
    ("rain", "chuva_mm", "double", "Rain of the hour, mm"),
    ("showers", "pancadas_mm", "double", "Showers of the hour, mm"),
    ("weathercode", "codigo_tempo", "int", "WMO weather code"),
    ("pressure_msl", "pressao_nivel_mar_hpa", "double", "Pressure at mean sea level, hPa"),
    ("surface_pressure", "pressao_superficie_hpa", "double", "Surface pressure, hPa"),
    ("cloud_cover", "cobertura_nuvens_pct", "double", "Total cloud cover, %"),
    ("cloud_cover_low", "nuvens_baixas_pct", "double", "Low cloud cover, %"),
    ("cloud_cover_mid", "nuvens_medias_pct", "double", "Mid-level cloud cover, %"),
    ("cloud_cover_high", "nuvens_altas_pct", "double", "High cloud cover, %"),
    ("wind_speed_10m", "vento_velocidade_10m_kmh", "double", "Wind speed at 10 m, km/h"),
    ("wind_direction_10m", "vento_direcao_10m_graus", "double", "Wind direction at 10 m, degrees"),
    ("wind_gusts_10m", "vento_rajada_10m_kmh", "double", "Wind gusts at 10 m, km/h"),
    ("wind_speed_100m", "vento_velocidade_100m_kmh", "double", "Wind speed at 100 m, km/h"),
    ("wind_direction_100m", "vento_direcao_100m_graus", "double", "Wind direction at 100 m, degrees"),
    ("shortwave_radiation", "radiacao_solar_wm2", "double", "Shortwave radiation, W/m²"),
    ("uv_index", "indice_uv", "double", "UV index"),
    ("visibility", "visibilidade_m", "double", "Visibility, m"),
    ("is_day", "periodo_diurno", "boolean", "True between sunrise and sunset"),
)

# Layouts of the raw tables, without the source label.
_POINT = (
    "ponto_id string, uf string, tipo_ponto string, latitude_requested double, longitude_requested double"
)
RAW_LAYOUTS = {
    "ons.carga_energia": (
        "id_subsistema string, nom_subsistema string, din_instante timestamp, "
        "val_cargaenergiamwmed double, ingestion_timestamp timestamp"
    ),
    "ons.geracao_usina": (
        "din_instante timestamp, id_subsistema string, nom_subsistema string, id_estado string, "
        "nom_estado string, cod_modalidadeoperacao string, nom_tipousina string, nom_tipocombustivel string, "
        "nom_usina string, id_ons string, ceg string, val_geracao double, ingestion_timestamp timestamp"
    ),
    "ons.fator_capacidade": (
        "id_subsistema string, nom_subsistema string, id_estado string, nom_estado string, "
        "cod_pontoconexao string, nom_pontoconexao string, nom_localizacao string, "
        "val_latitudesecoletora double, val_longitudesecoletora double, val_latitudepontoconexao double, "
        "val_longitudepontoconexao double, nom_modalidadeoperacao string, nom_tipousina string, "
        "nom_usina_conjunto string, id_ons string, ceg string, din_instante timestamp, "
        "val_geracaoprogramada string, val_geracaoverificada string, val_capacidadeinstalada string, "
        "val_fatorcapacidade double, ingestion_timestamp timestamp"
    ),
    "ons.previsao_programado_eolsol": (
        "dat_programacao string, num_patamar int, cod_usinapdp string, nom_usinapdp string, "
        "val_previsao string, val_programado string, ingestion_timestamp timestamp"
    ),
    "open_meteo.previsao_bruta": (
        f"{_POINT}, data_referencia string, data_prevista string, horizonte_dias bigint, "
        "raw_response string, ingestion_timestamp timestamp"
    ),
    "open_meteo.previsao_historica_bruta": (
        f"{_POINT}, start_date string, end_date string, horizonte_dias bigint, "
        "raw_response string, ingestion_timestamp timestamp"
    ),
    "open_meteo.historico_observado": (
        f"{_POINT}, start_date string, end_date string, raw_response string, ingestion_timestamp timestamp"
    ),
}

# Ingestion feeds: pipeline, source label, raw table, file published per period.
FEEDS = {
    "previsao": ("01_forecast_clima", "open-meteo-forecast-daily", "open_meteo.previsao_bruta", None),
    "geracao": ("02_geracao_usina", "ons-geracao-usina-daily", "ons.geracao_usina", "GERACAO_USINA-2_{:%Y_%m}.parquet"),
    "capacidade": (
        "03_fator_capacidade", "ons-fator-capacidade-monthly", "ons.fator_capacidade", "FATOR_CAPACIDADE-2_{:%Y_%m}.parquet",
    ),
    "programacao": (
        "04_previsao_programado", "ons-previsao-programado-daily", "ons.previsao_programado_eolsol",
        "PROGRAMACAO_X_PREVISAO_{:%Y_%m_%d}.parquet",
    ),
    "carga": ("05_carga_energia", "ons-carga-energia-weekly", "ons.carga_energia", "CARGA_ENERGIA_{:%Y}.parquet"),
    "observado": ("06_historical_clima", "open-meteo-historical-weekly", "open_meteo.historico_observado", None),
    "previsao_anterior": (
        "07_previsao_clima_historica", "open-meteo-previous-runs", "open_meteo.previsao_historica_bruta", None,
    ),
}
LOAD_WINDOW_DAYS = 60
SCHEDULE_LAG_DAYS = 1
OBSERVED_LAG_DAYS = (16, 10)

# Column names and types of the clean tables.
POINT_COLUMNS = columns(
    ("ponto_id", "string", "Weather point: center of one kind of plants in a state, or a capital"),
    ("uf", "string", "State code of the point"),
    ("tipo_ponto", "string", "eolica, solar or capital"),
)
HOUR_COLUMN = columns(("data_hora", "timestamp_ntz", "Local hour, no time zone"))
WEATHER_COLUMNS = columns(*[(column, kind, comment) for _, column, kind, comment in WEATHER_VARIABLES])
GRID_COLUMNS = columns(
    ("latitude_grade", "double", "Latitude of the grid cell that answered"),
    ("longitude_grade", "double", "Longitude of the grid cell that answered"),
)
FORECAST_COLUMNS = (
    *POINT_COLUMNS,
    *columns(
        ("data_emissao", "date", "Day the forecast was issued"),
        ("data_prevista", "date", "Day the forecast describes"),
        ("horizonte_dias", "int", "Days from issue to described day"),
        ("origem", "string", "coleta_diaria or previsoes_anteriores"),
    ),
    *HOUR_COLUMN,
    *WEATHER_COLUMNS,
    *GRID_COLUMNS,
)
OBSERVED_COLUMNS = (*POINT_COLUMNS, *HOUR_COLUMN, *WEATHER_COLUMNS, *GRID_COLUMNS)
LOAD_COLUMNS = columns(
    ("id_subsistema", "string", "Subsystem code: N, NE, S, SE"),
    ("subsistema", "string", "Subsystem name"),
    ("data", "date", "Day measured"),
    ("carga_mwmed", "double", "Mean load of the day, MW"),
)
GENERATION_COLUMNS = columns(
    ("data_hora", "timestamp_ntz", "Local hour measured, no time zone"),
    ("chave_usina", "string", "Plant key: registry code and name"),
    ("nome_usina", "string", "Plant name"),
    ("ceg", "string", "Registry code; null for grouped plants"),
    ("id_ons", "string", "Operator's plant code; null for small plants"),
    ("tipo_usina", "string", "Kind of plant"),
    ("combustivel", "string", "Fuel of thermal plants"),
    ("modalidade_operacao", "string", "Operation mode"),
    ("id_subsistema", "string", "Subsystem code: N, NE, S, SE"),
    ("subsistema", "string", "Subsystem name"),
    ("uf", "string", "State code"),
    ("geracao_mwmed", "double", "Mean generation of the hour, MW; null when not metered hourly"),
)
CAPACITY_COLUMNS = columns(
    ("data_hora", "timestamp_ntz", "Local hour measured, no time zone"),
    ("id_ons", "string", "Operator's code of the plant or of its part of one kind"),
    ("nome_usina", "string", "Plant name"),
    ("ceg", "string", "Registry code; null for grouped plants"),
    ("tipo_usina", "string", "Kind of plant"),
    ("modalidade_operacao", "string", "Operation mode"),
    ("id_subsistema", "string", "Subsystem code: N, NE, S, SE"),
    ("subsistema", "string", "Subsystem name"),
    ("uf", "string", "State code"),
    ("codigo_ponto_conexao", "string", "Code of the grid connection point"),
    ("nome_ponto_conexao", "string", "Name of the grid connection point"),
    ("localizacao", "string", "Location as published"),
    ("latitude_coletora", "double", "Latitude of the collector substation"),
    ("longitude_coletora", "double", "Longitude of the collector substation"),
    ("latitude_ponto_conexao", "double", "Latitude of the connection point"),
    ("longitude_ponto_conexao", "double", "Longitude of the connection point"),
    ("geracao_programada_mwmed", "double", "Scheduled generation of the hour, MW"),
    ("geracao_verificada_mwmed", "double", "Actual generation of the hour, MW"),
    ("capacidade_instalada_mw", "double", "Installed capacity, MW"),
    ("fator_capacidade", "double", "Actual generation over installed capacity, 0 to 1"),
)
SCHEDULE_COLUMNS = columns(
    ("data", "date", "Day scheduled"),
    ("patamar", "int", "Half hour of the day, 1 (00:00) to 48 (23:30)"),
    ("inicio_patamar", "timestamp_ntz", "Start of the half hour, local, no time zone"),
    ("codigo_usina", "string", "Plant code in the schedule"),
    ("nome_usina", "string", "Plant name in the schedule"),
    ("previsao_mwmed", "double", "Forecast generation of the half hour, MW"),
    ("programado_mwmed", "double", "Scheduled generation of the half hour, MW"),
)

# Drop and warn rules per clean table.
LOAD_DROP = {
    "chave_presente": "id_subsistema IS NOT NULL AND data IS NOT NULL",
    "subsistema_conhecido": "subsistema IS NOT NULL",
    "carga_presente": "carga_mwmed IS NOT NULL",
}
LOAD_WARN = {"carga_positiva": "carga_mwmed > 0"}
GENERATION_DROP = {
    "chave_presente": "data_hora IS NOT NULL AND nome_usina IS NOT NULL",
    "subsistema_conhecido": "subsistema IS NOT NULL",
}
GENERATION_WARN = {
    "tipo_usina_conhecido": "tipo_usina IS NOT NULL",
    "geracao_plausivel": "geracao_mwmed IS NULL OR geracao_mwmed >= -10",
}
CAPACITY_DROP = {
    "chave_presente": "data_hora IS NOT NULL AND id_ons IS NOT NULL",
    "subsistema_conhecido": "subsistema IS NOT NULL",
}
CAPACITY_WARN = {
    "tipo_usina_conhecido": "tipo_usina IN ('Eólica', 'Solar')",
    "valores_numericos": "geracao_verificada_mwmed IS NOT NULL AND capacidade_instalada_mw IS NOT NULL",
    "fator_plausivel": "fator_capacidade BETWEEN -0.05 AND 1",
}
SCHEDULE_DROP = {
    "chave_presente": "data IS NOT NULL AND codigo_usina IS NOT NULL",
    "patamar_valido": "patamar BETWEEN 1 AND 48",
}
SCHEDULE_WARN = {
    "valores_numericos": "previsao_mwmed IS NOT NULL AND programado_mwmed IS NOT NULL",
    "valores_nao_negativos": "previsao_mwmed >= 0 AND programado_mwmed >= 0",
}
WEATHER_DROP = {
    "chave_presente": "ponto_id IS NOT NULL AND data_hora IS NOT NULL",
    # A response that is no JSON, or an error message, gives neither hours nor a grid point.
    "resposta_legivel": "data_hora IS NOT NULL OR latitude_grade IS NOT NULL OR longitude_grade IS NOT NULL",
}
FORECAST_DROP = {**WEATHER_DROP, "emissao_presente": "data_emissao IS NOT NULL"}
WEATHER_WARN = {
    "temperatura_plausivel": "temperatura_c BETWEEN 5 AND 48",
    "umidade_valida": "umidade_relativa_pct BETWEEN 0 AND 100",
    "radiacao_nao_negativa": "radiacao_solar_wm2 >= 0",
    "vento_nao_negativo": "vento_velocidade_100m_kmh >= 0",
}

# Column names and types of the metric tables.
MONTHLY_CAPACITY_COLUMNS = columns(
    ("mes", "date", "First day of the month"),
    ("uf", "string", "State code"),
    ("tipo_usina", "string", "Kind of plant"),
    ("usinas", "bigint", "Plants with a measurement in the month"),
    ("geracao_verificada_mwh", "double", "Energy generated, MWh"),
    ("geracao_programada_mwh", "double", "Energy scheduled, MWh"),
    ("capacidade_mwh", "double", "Energy at full capacity during the measured hours, MWh"),
    ("fator_capacidade", "double", "Generated over capacity, 0 to 1"),
    ("fator_capacidade_programado", "double", "Scheduled over capacity, 0 to 1"),
)
DAILY_SHORTFALL_COLUMNS = columns(
    ("data", "date", "Day scheduled"),
    ("usinas", "bigint", "Plants scheduled that day"),
    ("previsto_mwh", "double", "Energy forecast, MWh"),
    ("programado_mwh", "double", "Energy scheduled, MWh"),
    ("restricao_mwh", "double", "Energy forecast and not scheduled, MWh"),
    ("restricao_pct", "double", "Shortfall over forecast, 0 to 1"),
    ("meias_horas_com_restricao_pct", "double", "Share of plant half hours with a shortfall, 0 to 1"),
)
PLANT_SHORTFALL_COLUMNS = columns(
    ("mes", "date", "First day of the month"),
    ("codigo_usina", "string", "Plant code in the schedule"),
    ("nome_usina", "string", "Plant name in the schedule"),
    ("previsto_mwh", "double", "Energy forecast, MWh"),
    ("restricao_mwh", "double", "Energy forecast and not scheduled, MWh"),
    ("restricao_pct", "double", "Shortfall over forecast, 0 to 1"),
)
SCHEDULE_ERROR_COLUMNS = columns(
    ("mes", "date", "First day of the month"),
    ("uf", "string", "State code"),
    ("tipo_usina", "string", "Kind of plant"),
    ("geracao_programada_mwh", "double", "Energy scheduled, MWh"),
    ("geracao_verificada_mwh", "double", "Energy generated, MWh"),
    ("erro_absoluto_mwh", "double", "Sum of hourly absolute differences per plant, MWh"),
    ("erro_relativo", "double", "Absolute error over energy generated (WAPE)"),
    ("vies_relativo", "double", "(generated - scheduled) / scheduled"),
)
WEATHER_GENERATION_COLUMNS = columns(
    ("data_hora", "timestamp_ntz", "Local hour, no time zone"),
    ("uf", "string", "State code"),
    ("tipo_usina", "string", "Kind of plant"),
    ("ponto_id", "string", "Weather point of the state's plants of this kind"),
    ("geracao_verificada_mwmed", "double", "Generation of the hour, MW"),
    ("capacidade_mw", "double", "Installed capacity, MW"),
    ("fator_capacidade", "double", "Generation over capacity, 0 to 1"),
    ("vento_100m_ms", "double", "Wind speed at 100 m, m/s"),
    ("radiacao_solar_wm2", "double", "Solar radiation, W/m²"),
    ("cobertura_nuvens_pct", "double", "Cloud cover, %"),
    ("temperatura_c", "double", "Air temperature, °C"),
    ("precipitacao_mm", "double", "Precipitation of the hour, mm"),
)
POWER_CURVE_COLUMNS = columns(
    ("tipo_usina", "string", "Kind of plant"),
    ("variavel", "string", "Weather variable of the curve"),
    ("faixa_inicio", "double", "Start of the bin, included"),
    ("faixa_fim", "double", "End of the bin, not included"),
    ("horas", "bigint", "State hours in the bin"),
    ("fator_capacidade", "double", "Total generation over total capacity in the bin"),
    ("fator_capacidade_p25", "double", "25th percentile of the hourly capacity factor"),
    ("fator_capacidade_p75", "double", "75th percentile of the hourly capacity factor"),
)
CORRELATION_COLUMNS = columns(
    ("uf", "string", "State code"),
    ("tipo_usina", "string", "Kind of plant"),
    ("variavel", "string", "Weather variable"),
    ("correlacao", "double", "Pearson correlation with the hourly capacity factor"),
    ("horas", "bigint", "Hours used"),
)
WEATHER_ACCURACY_COLUMNS = columns(
    ("mes", "date", "First day of the month"),
    ("ponto_id", "string", "Weather point"),
    ("uf", "string", "State code of the point"),
    ("tipo_ponto", "string", "eolica, solar or capital"),
    ("horas", "bigint", "Hours with both forecast and observation"),
    ("vento_100m_observado_kmh", "double", "Mean observed wind at 100 m, km/h"),
    ("erro_medio_absoluto_vento_100m_kmh", "double", "Mean absolute error of the wind forecast, km/h"),
    ("vies_vento_100m_kmh", "double", "Mean of forecast minus observed wind, km/h"),
    ("radiacao_observada_wm2", "double", "Mean observed radiation in sunny hours, W/m²"),
    ("erro_medio_absoluto_radiacao_wm2", "double", "Mean absolute error of radiation in sunny hours, W/m²"),
    ("vies_radiacao_wm2", "double", "Mean of forecast minus observed radiation in sunny hours, W/m²"),
    ("erro_medio_absoluto_temperatura_c", "double", "Mean absolute error of temperature, °C"),
)
LOAD_TEMPERATURE_COLUMNS = columns(
    ("data", "date", "Day"),
    ("carga_mwmed", "double", "Mean load of the subsystem, MW"),
    ("temperatura_media_c", "double", "Mean temperature of the capitals, °C"),
    ("temperatura_maxima_c", "double", "Highest hourly temperature of the capitals, °C"),
    ("dia_semana", "int", "ISO weekday, 1 is Monday and 7 is Sunday"),
    ("fim_de_semana", "boolean", "Saturday or Sunday"),
)
