"""SQL equivalents of the workload queries, for DuckDB over the same tables."""

from __future__ import annotations

from itertools import combinations

# --- the raw layouts and clean tables as common table expressions ------------------------------

REGION = "CASE r_name WHEN 'ASIA' THEN 'NE' WHEN 'AFRICA' THEN 'N' WHEN 'AMERICA' THEN 'S' WHEN 'EUROPE' THEN 'SE' ELSE 'XX' END"
SUBSYSTEM = "CASE {} WHEN 'N' THEN 'Norte' WHEN 'NE' THEN 'Nordeste' WHEN 'S' THEN 'Sul' WHEN 'SE' THEN 'Sudeste/Centro-Oeste' END"
KIND = "CASE l_returnflag WHEN 'A' THEN 'Eólica' WHEN 'R' THEN 'Solar' WHEN 'N' THEN 'Térmica' END"
POINT_KIND = "CASE l_returnflag WHEN 'A' THEN 'eolica' WHEN 'R' THEN 'solar' ELSE 'capital' END"
DELIVERED = "(l_quantity - round(l_discount * 100) / 16)"
INGESTED = "make_timestamp(l_orderkey * 8 + l_linenumber)"
PLACES = """lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""
HOUR = "l_shipdate + to_hours(l_linenumber)"
PRIORITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'N' WHEN '2-HIGH' THEN 'NE' WHEN '3-MEDIUM' THEN 'S'
  WHEN '4-NOT SPECIFIED' THEN 'SE' ELSE 'XX' END"""

LOAD = f"""load_all AS (
  SELECT id_subsistema, {SUBSYSTEM.format('id_subsistema')} AS subsistema, data, carga_mwmed, ingerido_em FROM (
    SELECT {PRIORITY} AS id_subsistema, CAST(o_orderdate AS DATE) AS data,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 100000) AS DOUBLE) END AS carga_mwmed,
      make_timestamp(o_orderkey) AS ingerido_em
    FROM orders)),
load_ok AS (SELECT * FROM load_all WHERE subsistema IS NOT NULL AND carga_mwmed IS NOT NULL),
load_now AS (SELECT * FROM load_ok QUALIFY row_number() OVER (
  PARTITION BY id_subsistema, data ORDER BY ingerido_em DESC, carga_mwmed DESC) = 1)"""

GENERATION = f"""gen_ok AS (
  SELECT data_hora, chave_usina, nome_usina, ceg, CAST(NULL AS VARCHAR) AS id_ons, tipo_usina, combustivel,
    modalidade_operacao, id_subsistema, {SUBSYSTEM.format('id_subsistema')} AS subsistema, uf, geracao_mwmed, ingerido_em
  FROM (
    SELECT {HOUR} AS data_hora, CASE l_returnflag WHEN 'R' THEN 'CEG.1' ELSE '-' END || ' | ' || s_name AS chave_usina,
      s_name AS nome_usina, CASE l_returnflag WHEN 'R' THEN 'CEG.1' END AS ceg, {KIND} AS tipo_usina,
      nullif(l_linestatus, 'O') AS combustivel,
      CASE WHEN l_linestatus = 'O' THEN 'Tipo III' ELSE 'Pequenas Usinas' END AS modalidade_operacao,
      {REGION} AS id_subsistema, n_name AS uf, l_quantity - 12 AS geracao_mwmed, {INGESTED} AS ingerido_em
    FROM {PLACES}) WHERE id_subsistema <> 'XX')"""

CAPACITY = f"""cap_all AS (
  SELECT data_hora, id_ons, nome_usina, tipo_usina, id_subsistema, {SUBSYSTEM.format('id_subsistema')} AS subsistema, uf,
    localizacao, lat, lon, prog, verif, fator, ingerido_em
  FROM (
    SELECT {HOUR} AS data_hora, CAST(l_suppkey AS VARCHAR) AS id_ons, s_name AS nome_usina, {KIND} AS tipo_usina,
      {REGION} AS id_subsistema, n_name AS uf, r_name AS localizacao, s_acctbal / 1000 AS lat, s_acctbal / -500 AS lon,
      l_quantity AS prog, CASE WHEN l_tax = 0.08 THEN NULL ELSE {DELIVERED} END AS verif,
      {DELIVERED} / 50 AS fator, {INGESTED} AS ingerido_em
    FROM {PLACES})),
cap AS (SELECT * FROM cap_all WHERE subsistema IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY data_hora, id_ons
  ORDER BY ingerido_em DESC, tipo_usina DESC, prog DESC, verif DESC NULLS LAST, fator DESC) = 1),
scope AS (SELECT * FROM cap WHERE id_subsistema = 'NE' AND tipo_usina IN ('Eólica', 'Solar'))"""

SCHEDULE = f"""sch_all AS (
  SELECT CAST(l_shipdate AS DATE) AS data, CAST(l_linenumber * 7 AS INTEGER) AS patamar,
    CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS TIMESTAMP) + to_minutes((l_linenumber * 7 - 1) * 30) END AS inicio_patamar,
    'U' || l_suppkey AS codigo_usina, 'Plant ' || l_suppkey AS nome_usina,
    CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity END AS previsao_mwmed, {DELIVERED} AS programado_mwmed,
    {INGESTED} AS ingerido_em FROM lineitem),
sch_ok AS (SELECT * FROM sch_all WHERE patamar BETWEEN 1 AND 48),
sch AS (SELECT * FROM sch_ok QUALIFY row_number() OVER (
  PARTITION BY data, patamar, codigo_usina
  ORDER BY ingerido_em DESC, previsao_mwmed DESC NULLS LAST, programado_mwmed DESC) = 1)"""


def _hours(pick: str, extra: str = "") -> str:
    also = f", {extra}" if extra else ""
    return f"""SELECT lower(n_name) || '-' || {POINT_KIND} AS ponto_id, n_name AS uf, {POINT_KIND} AS tipo_ponto,
    CAST(l_shipdate AS DATE) AS dia, {HOUR} AS data_hora{also},
    {pick}(l_quantity) AS vento_velocidade_100m_kmh, round({pick}(l_discount) * 100) * 100 AS radiacao_solar_wm2,
    round({pick}(l_tax) * 100) * 10 AS cobertura_nuvens_pct, {pick}(l_quantity) / 2 + 10 AS temperatura_c,
    CAST({pick}(l_linenumber) AS DOUBLE) AS precipitacao_mm, max(l_orderkey) AS newest
  FROM {PLACES} GROUP BY ALL"""


OBSERVED = f"""obs AS ({_hours('max')})"""
HORIZON = "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS horizonte_dias"
FORECAST = f"""fc AS (SELECT * FROM ({_hours('min', HORIZON)}))"""

BLANK_WEATHER = """NULL::DOUBLE AS sensacao_termica_c, NULL::DOUBLE AS umidade_relativa_pct, NULL::DOUBLE AS ponto_orvalho_c,
  NULL::DOUBLE AS chuva_mm, NULL::DOUBLE AS pancadas_mm, NULL::INTEGER AS codigo_tempo, NULL::DOUBLE AS pressao_nivel_mar_hpa,
  NULL::DOUBLE AS pressao_superficie_hpa, NULL::DOUBLE AS nuvens_baixas_pct, NULL::DOUBLE AS nuvens_medias_pct,
  NULL::DOUBLE AS nuvens_altas_pct, NULL::DOUBLE AS vento_velocidade_10m_kmh, NULL::DOUBLE AS vento_direcao_10m_graus,
  NULL::DOUBLE AS vento_rajada_10m_kmh, NULL::DOUBLE AS vento_direcao_100m_graus, NULL::DOUBLE AS indice_uv,
  NULL::DOUBLE AS visibilidade_m, NULL::BOOLEAN AS periodo_diurno, -11.5::DOUBLE AS latitude_grade, -41.5::DOUBLE AS longitude_grade"""
WEATHER = """round(temperatura_c, 6) AS temperatura_c, round(precipitacao_mm, 6) AS precipitacao_mm,
  round(cobertura_nuvens_pct, 6) AS cobertura_nuvens_pct,
  round(vento_velocidade_100m_kmh, 6) AS vento_velocidade_100m_kmh, round(radiacao_solar_wm2, 6) AS radiacao_solar_wm2"""


def _history(source: str, keys: str, order: str, tracked: str, ties: str, output: str) -> str:
    """Versions of a keyed table: collapse equal instants, find changes, take each run's last row."""
    same = " AND ".join(f"p_{c} IS NOT DISTINCT FROM {c}" for c in tracked.split(", "))
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked.split(", "))
    return f"""one AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys}, {order} ORDER BY {ties}) = 1),
step AS (SELECT *, {lags}, row_number() OVER w AS rn FROM one WINDOW w AS (PARTITION BY {keys} ORDER BY {order})),
run AS (SELECT *, sum(CASE WHEN rn > 1 AND {same} THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM step),
ends AS (SELECT *, min({order}) OVER (PARTITION BY {keys}, n) AS start_at, row_number() OVER (
  PARTITION BY {keys}, n ORDER BY {order} DESC) AS back FROM run),
hist AS (SELECT *, lead(start_at) OVER (PARTITION BY {keys} ORDER BY start_at) AS end_at FROM ends WHERE back = 1)
{output}"""


READABLE = """CAST(n AS INTEGER) AS numero_versao, start_at AS vigente_desde, end_at AS vigente_ate,
  end_at IS NULL AS versao_atual"""

# --- metric tables --------------------------------------------------------------------------------

MONTHLY = """monthly AS (SELECT CAST(date_trunc('month', data_hora) AS DATE) AS mes, uf, tipo_usina, count(DISTINCT id_ons) AS usinas,
  sum(verif) AS geracao_verificada_mwh, sum(prog) AS geracao_programada_mwh, sum(50.0::DOUBLE) AS capacidade_mwh
  FROM scope GROUP BY ALL)"""
ERRORS = """errors AS (SELECT CAST(date_trunc('month', data_hora) AS DATE) AS mes, uf, tipo_usina,
  sum(prog) AS geracao_programada_mwh, sum(verif) AS geracao_verificada_mwh, sum(abs(prog - verif)) AS erro_absoluto_mwh
  FROM scope GROUP BY ALL)"""
DAILY = """daily AS (SELECT data, count(DISTINCT codigo_usina) AS usinas, sum(previsao_mwmed) * 0.5 AS previsto_mwh,
  sum(programado_mwmed) * 0.5 AS programado_mwh, sum(greatest(previsao_mwmed - programado_mwmed, 0)) * 0.5 AS restricao_mwh,
  avg(CAST(previsao_mwmed - programado_mwmed > 0.5 AS INTEGER)) AS share FROM sch GROUP BY data)"""
PLANTS = """plants AS (SELECT CAST(date_trunc('month', data) AS DATE) AS mes, codigo_usina, max(nome_usina) AS nome_usina,
  sum(previsao_mwmed) * 0.5 AS previsto_mwh, sum(greatest(previsao_mwmed - programado_mwmed, 0)) * 0.5 AS restricao_mwh
  FROM sch GROUP BY ALL)"""
JOINED = f"""hourly AS (SELECT data_hora, uf, tipo_usina, sum(verif) AS g, sum(50.0::DOUBLE) AS c FROM scope GROUP BY ALL),
wg AS (SELECT h.data_hora, h.uf, tipo_usina, o.ponto_id, g, c, g / c AS f, vento_velocidade_100m_kmh / 3.6 AS vento_100m_ms,
  radiacao_solar_wm2, cobertura_nuvens_pct, temperatura_c, precipitacao_mm
  FROM hourly h JOIN obs o ON o.data_hora = h.data_hora
    AND o.ponto_id = lower(h.uf) || CASE tipo_usina WHEN 'Eólica' THEN '-eolica' ELSE '-solar' END)"""
CURVE = """binned AS (SELECT tipo_usina, CASE tipo_usina WHEN 'Eólica' THEN 'vento_100m_ms' ELSE 'radiacao_solar_wm2' END AS variavel,
  CASE tipo_usina WHEN 'Eólica' THEN vento_100m_ms ELSE radiacao_solar_wm2 END AS x,
  CASE tipo_usina WHEN 'Eólica' THEN 1.0::DOUBLE ELSE 50.0::DOUBLE END AS w, f, g, c FROM wg WHERE f IS NOT NULL),
curve AS (SELECT tipo_usina, variavel, floor(x / w) * w AS faixa_inicio, floor(x / w) * w + w AS faixa_fim, count(*) AS horas,
  sum(g) / sum(c) AS fator_capacidade, quantile_disc(f, 0.25) AS p25, quantile_disc(f, 0.75) AS p75
  FROM binned WHERE x IS NOT NULL GROUP BY ALL)"""


def _pair(kind: str, variable: str) -> str:
    sunny = " AND radiacao_solar_wm2 > 0" if kind == "Solar" else ""
    pairs = f"FILTER ({variable} IS NOT NULL AND f IS NOT NULL)"
    return f"""SELECT uf, tipo_usina, '{variable}' AS variavel,
  CASE WHEN min({variable}) {pairs} < max({variable}) {pairs} AND min(f) {pairs} < max(f) {pairs} THEN corr({variable}, f) END AS correlacao,
  count(*) AS horas FROM wg WHERE tipo_usina = '{kind}'{sunny} GROUP BY uf, tipo_usina"""


CORRELATION = "corrs AS (" + " UNION ALL ".join(
    _pair(*p) for p in (
        ("Eólica", "vento_100m_ms"), ("Eólica", "temperatura_c"), ("Solar", "radiacao_solar_wm2"),
        ("Solar", "cobertura_nuvens_pct"), ("Solar", "temperatura_c"),
    )
) + ")"
ACCURACY = """acc AS (SELECT CAST(date_trunc('month', f.data_hora) AS DATE) AS mes, f.ponto_id, f.uf, f.tipo_ponto, count(*) AS horas,
  avg(o.vento_velocidade_100m_kmh) AS vento_100m_observado_kmh,
  avg(abs(f.vento_velocidade_100m_kmh - o.vento_velocidade_100m_kmh)) AS erro_medio_absoluto_vento_100m_kmh,
  avg(f.vento_velocidade_100m_kmh - o.vento_velocidade_100m_kmh) AS vies_vento_100m_kmh,
  avg(o.radiacao_solar_wm2) FILTER (o.radiacao_solar_wm2 > 0) AS radiacao_observada_wm2,
  avg(abs(f.radiacao_solar_wm2 - o.radiacao_solar_wm2)) FILTER (o.radiacao_solar_wm2 > 0) AS erro_medio_absoluto_radiacao_wm2,
  avg(f.radiacao_solar_wm2 - o.radiacao_solar_wm2) FILTER (o.radiacao_solar_wm2 > 0) AS vies_radiacao_wm2,
  avg(abs(f.temperatura_c - o.temperatura_c)) AS erro_medio_absoluto_temperatura_c
  FROM fc f JOIN obs o ON f.ponto_id = o.ponto_id AND f.data_hora = o.data_hora WHERE f.horizonte_dias = 1 GROUP BY ALL)"""
HEAT = """heat AS (SELECT l.data, l.carga_mwmed, avg(o.temperatura_c) AS temperatura_media_c, max(o.temperatura_c) AS temperatura_maxima_c
  FROM load_now l JOIN obs o ON CAST(o.data_hora AS DATE) = l.data
  WHERE l.id_subsistema = 'NE' AND o.tipo_ponto = 'capital' GROUP BY l.data, l.carga_mwmed)"""
RATIO = "CASE WHEN {1} > 0 THEN {0} / {1} END"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _counts(table: str, source: str, drop: dict[str, str], warn: dict[str, str]) -> str:
    kept = " AND ".join(f"coalesce({c}, false)" for c in drop.values())
    parts = [
        f"SELECT '{table}' AS \"table\", '{n}' AS rule, 'drop' AS kind, count(*) FILTER (coalesce({c}, false)) AS passed, "
        f"count(*) FILTER (NOT coalesce({c}, false)) AS failed FROM {source}" for n, c in drop.items()
    ] + [
        f"SELECT '{table}', '{n}', 'warn', count(*) FILTER ({kept} AND coalesce({c}, true)), "
        f"count(*) FILTER ({kept} AND NOT coalesce({c}, true)) FROM {source}" for n, c in warn.items()
    ]
    return " UNION ALL ".join(parts)


def _percent(top: str, bottom: str, only: str = "true") -> str:
    return f"round(sum({top}) FILTER ({only}) / sum({bottom}) FILTER ({only}) * 100, 1)"


GENERATED = ("geracao_verificada_mwh", "capacidade_mwh")


LOAD_COLUMNS = "id_subsistema, subsistema, data, carga_mwmed"
LOAD_HISTORY = lambda output: _with(LOAD) .rstrip() + ",\n" + _history(
    "load_ok", "id_subsistema, data", "ingerido_em", "carga_mwmed", "carga_mwmed DESC", output
)
LOAD_HELD = """SELECT *, array_to_string(list_filter([CASE WHEN subsistema IS NULL THEN 'subsistema_conhecido' END,
  CASE WHEN carga_mwmed IS NULL THEN 'carga_presente' END], lambda x: x IS NOT NULL), ',') AS regras_violadas
  FROM load_all WHERE subsistema IS NULL OR carga_mwmed IS NULL"""
LOAD_COUNTS = _with(LOAD) + _counts(
    "carga_energia", "load_all",
    {"chave_presente": "id_subsistema IS NOT NULL AND data IS NOT NULL", "subsistema_conhecido": "subsistema IS NOT NULL",
     "carga_presente": "carga_mwmed IS NOT NULL"},
    {"carga_positiva": "carga_mwmed > 0"},
)
LOAD_VERSIONS = LOAD_HISTORY(f"SELECT {LOAD_COLUMNS}, {READABLE}, ingerido_em AS confirmado_em FROM hist")

LEVELS = "levels AS (SELECT user_id, event_type, ts, CAST(floor(value / 25) AS BIGINT) AS level, event_id FROM events)"


def _levels(keys: str, output: str) -> str:
    ties = "event_id DESC" if keys == "event_type" else "level DESC, event_id DESC"
    if keys == "event_type":
        ties = "user_id DESC, level DESC, event_id DESC"
    return _with(LEVELS).rstrip() + ",\n" + _history("levels", keys, "ts", "level", ties, output)


EVENT_RULES = {"value_in_range": "value BETWEEN 5 AND 150", "not_error": "nullif(event_type, 'view') <> 'error'"}
VIOLATED = """array_to_string(list_filter([CASE WHEN NOT coalesce(value BETWEEN 5 AND 150, false) THEN 'value_in_range' END,
  CASE WHEN NOT coalesce(nullif(event_type, 'view') <> 'error', false) THEN 'not_error' END], lambda x: x IS NOT NULL), ',')"""
EVENT_OK = "coalesce(value BETWEEN 5 AND 150, false) AND coalesce(nullif(event_type, 'view') <> 'error', false)"
LOCAL = "(({}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo'"
SECOND = "date_trunc('second', ts)"
HOURLY = "hourly AS (SELECT event_type, date_trunc('hour', ts) AS hour, max(value) AS x FROM events GROUP BY ALL)"
PAIR_DAYS = """p AS (SELECT CAST(ts AS DATE) AS day, max(value) FILTER (event_type = 'purchase') AS bought,
  max(value) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1 HAVING bought IS NOT NULL AND failed IS NOT NULL)"""
EVENT_LOG = """log AS (SELECT event_type IN ('purchase', 'signup') AS is_quality, event_type, user_id,
  date_trunc('second', ts) AS t, CASE WHEN value > 40 THEN 'COMPLETED' ELSE 'RUNNING' END AS state, value,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""
ORDERS = "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE "

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _natural_keys(table: str, columns: tuple[str, ...]) -> str:
    """Keys of one column, and keys of two that hold no key of one."""
    distinct = ", ".join(f"count(DISTINCT {c}) AS {c}" for c in columns)
    row = "SELECT '{0}' AS candidate, {1} AS columns, CAST({2} AS BIGINT) AS distinct_rows, (SELECT count(*) FROM {3}) AS rows, true AS is_key"
    parts = [f"{row.format(c, 1, c, table)} FROM one WHERE {c} = (SELECT count(*) FROM {table})" for c in columns]
    for i, a in enumerate(columns):
        for b in columns[i + 1 :]:
            counted = f"(SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {table}))"
            n = f"(SELECT count(*) FROM {table})"
            parts.append(f"{row.format(f'{a} + {b}', 2, n, table)} FROM one WHERE {counted} = {n} AND {a} < {n} AND {b} < {n}")
    return f"WITH one AS (SELECT {distinct} FROM {table}) " + " UNION ALL ".join(parts)


def _profile(source: str, columns: tuple[str, ...], not_numbers: set[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count("{c}") AS nulls,
  round((count(*) - count("{c}")) / count(*), 6) AS null_share, CAST(min("{c}") AS VARCHAR) AS lowest, CAST(max("{c}") AS VARCHAR) AS highest,
  {'CAST(NULL AS BIGINT)' if c in not_numbers else f'count(*) FILTER ("{c}" < 0)'} AS negatives FROM {source}"""
        for c in columns
    )


FORECAST_HOURS = _with(FORECAST) + f"""SELECT ponto_id, uf, tipo_ponto, CAST(dia - horizonte_dias AS DATE) AS data_emissao,
  dia AS data_prevista, horizonte_dias, CASE WHEN tipo_ponto = 'solar' AND horizonte_dias = 1 THEN 'previsoes_anteriores' ELSE 'coleta_diaria' END AS origem,
  data_hora, {WEATHER}, {BLANK_WEATHER},
  make_timestamp(max(newest) OVER (PARTITION BY ponto_id, dia, horizonte_dias)) AS ingerido_em FROM fc"""
UNREADABLE = "answered AS (SELECT *, max(newest) OVER (PARTITION BY ponto_id, dia) AS n FROM obs)"


def _schedule_object(name: str, source: str, last: str = "ingerido_em") -> str:
    return f"""SELECT 'previsao_programado{name}' AS object, count(*) AS rows, count(DISTINCT (data, patamar, codigo_usina)) AS keys,
  max({last}) AS last, NULL::BIGINT AS failed FROM {source}"""


def _schedule_rule(kind: str, rule: str, source: str, failed: str) -> str:
    return f"""SELECT 'previsao_programado_regras {kind} {rule}', count(*), NULL, NULL, count(*) FILTER ({failed}) FROM {source}"""


SCHEDULE_OBJECTS = " UNION ALL ".join((
    _schedule_object("", "sch"),
    _schedule_object("_quarentena", "(SELECT * FROM sch_all WHERE patamar > 48)"),
    _schedule_object("_historico_cdc", "hist"),
    _schedule_object("_versoes", "hist"),
    _schedule_rule("drop", "chave_presente", "sch_all", "data IS NULL OR codigo_usina IS NULL"),
    _schedule_rule("drop", "patamar_valido", "sch_all", "NOT coalesce(patamar BETWEEN 1 AND 48, false)"),
    _schedule_rule("warn", "valores_numericos", "sch_ok", "previsao_mwmed IS NULL OR programado_mwmed IS NULL"),
    _schedule_rule("warn", "valores_nao_negativos", "sch_ok", "NOT coalesce(previsao_mwmed >= 0 AND programado_mwmed >= 0, true)"),
))


ORACLE: dict[str, str] = {
    "load_current": _with(LOAD) + "SELECT * FROM load_now",
    "load_quarantine": _with(LOAD) + LOAD_HELD,
    "load_rule_counts": LOAD_COUNTS,
    "load_history": LOAD_HISTORY(f"SELECT {LOAD_COLUMNS}, ingerido_em, start_at, end_at FROM hist"),
    "load_versions": LOAD_VERSIONS,
    "stream_current": _with(LOAD) + "SELECT * FROM load_now",
    "stream_quarantine": _with(LOAD) + LOAD_HELD,
    "stream_rule_counts": LOAD_COUNTS,
    "stream_versions": LOAD_VERSIONS,
    "stream_full_refresh": LOAD_VERSIONS,
    "stream_two_sources": FORECAST_HOURS,
    "clean_batch_objects": _with(SCHEDULE).rstrip() + ",\n" + _history(
        "sch_ok", "data, patamar, codigo_usina", "ingerido_em", "previsao_mwmed, programado_mwmed",
        "previsao_mwmed DESC NULLS LAST, programado_mwmed DESC",
        SCHEDULE_OBJECTS,
    ),
    "unreadable_responses": _with(OBSERVED, UNREADABLE) + """SELECT ponto_id, uf, tipo_ponto, NULL::TIMESTAMP AS data_hora,
  NULL::DOUBLE AS temperatura_c, NULL::DOUBLE AS latitude_grade, make_timestamp(n) AS ingerido_em,
  'chave_presente,resposta_legivel' AS regras_violadas FROM (SELECT DISTINCT ponto_id, uf, tipo_ponto, dia, n FROM answered) WHERE n % 5 < 2
UNION ALL SELECT ponto_id, uf, tipo_ponto, NULL, round(temperatura_c, 6), -11.5, make_timestamp(n), 'chave_presente'
  FROM answered WHERE n % 5 = 2 AND hour(data_hora) BETWEEN 1 AND 4""",
    "contract_checks": _with(OBSERVED, FORECAST) + " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS rows, true AS whole, false AS short, false AS other FROM {source}"""
        for name, source in (
            ("carga_energia", "orders"), ("geracao_usina", f"({PLACES})"), ("fator_capacidade", f"({PLACES})"),
            ("previsao_programado", "lineitem"), ("clima_observado", "obs"), ("clima_previsao", "fc"),
        )
    ),
    "documented_columns": _with(LOAD) + " UNION ALL ".join(
        f"""SELECT 'silver' AS layer, 'carga_energia' AS "table", CAST({position} AS INTEGER) AS position, '{name}' AS "column",
  '{kind}' AS type, true AS documented, count(*) AS rows, count(*) - count({name}) AS nulls FROM load_now"""
        for position, (name, kind) in enumerate(
            (("id_subsistema", "string"), ("subsistema", "string"), ("data", "date"), ("carga_mwmed", "double"), ("ingerido_em", "timestamp")), 1
        )
    ),
    "backfill_job_mixed_types": f"""SELECT {HOUR} AS din_instante, ' ' || s_name AS nom_usina,
  CASE l_returnflag WHEN 'A' THEN 'EOLIELÉTRICA' WHEN 'R' THEN ' Fotovoltaica' WHEN 'N' THEN 'TÉRMICA' END AS nom_tipousina,
  l_quantity - 12 AS val_geracao, count(*) OVER () AS written, count(*) OVER () AS told
FROM {PLACES} WHERE year({HOUR}) = 1997""",
    "generation_current": _with(GENERATION) + """SELECT * FROM gen_ok QUALIFY row_number() OVER (
  PARTITION BY data_hora, chave_usina ORDER BY ingerido_em DESC, tipo_usina DESC, combustivel DESC NULLS LAST,
  modalidade_operacao DESC, geracao_mwmed DESC) = 1""",
    "generation_versions": _with(GENERATION).rstrip() + ",\n" + _history(
        "gen_ok", "data_hora, chave_usina", "ingerido_em", "geracao_mwmed",
        "ceg DESC NULLS LAST, tipo_usina DESC, combustivel DESC NULLS LAST, modalidade_operacao DESC, geracao_mwmed DESC",
        f"SELECT data_hora, chave_usina, geracao_mwmed, {READABLE}, ingerido_em AS confirmado_em FROM hist",
    ),
    "capacity_current": _with(CAPACITY) + """SELECT data_hora, id_ons, nome_usina, NULL::VARCHAR AS ceg, tipo_usina,
  'Tipo II-B' AS modalidade_operacao, id_subsistema, subsistema, uf, NULL::VARCHAR AS codigo_ponto_conexao,
  NULL::VARCHAR AS nome_ponto_conexao, localizacao, round(lat, 6) AS latitude_coletora, round(lon, 6) AS longitude_coletora,
  NULL::DOUBLE AS latitude_ponto_conexao, NULL::DOUBLE AS longitude_ponto_conexao, round(prog, 6) AS geracao_programada_mwmed,
  round(verif, 6) AS geracao_verificada_mwmed, 50.0::DOUBLE AS capacidade_instalada_mw, round(fator, 6) AS fator_capacidade,
  ingerido_em FROM cap""",
    "capacity_quarantine": _with(CAPACITY) + """SELECT data_hora, id_ons, uf, ingerido_em, 'subsistema_conhecido' AS regras_violadas
  FROM cap_all WHERE subsistema IS NULL""",
    "capacity_rule_counts": _with(CAPACITY) + _counts(
        "fator_capacidade", "cap_all",
        {"chave_presente": "data_hora IS NOT NULL AND id_ons IS NOT NULL", "subsistema_conhecido": "subsistema IS NOT NULL"},
        {"tipo_usina_conhecido": "tipo_usina IN ('Eólica', 'Solar')", "valores_numericos": "verif IS NOT NULL",
         "fator_plausivel": "fator BETWEEN -0.05 AND 1"},
    ),
    "schedule_current": _with(SCHEDULE) + "SELECT * FROM sch",
    "schedule_quarantine": _with(SCHEDULE) + "SELECT *, 'patamar_valido' AS regras_violadas FROM sch_all WHERE patamar > 48",
    "schedule_versions": _with(SCHEDULE).rstrip() + ",\n" + _history(
        "sch_ok", "data, patamar, codigo_usina", "ingerido_em", "previsao_mwmed, programado_mwmed",
        "previsao_mwmed DESC NULLS LAST, programado_mwmed DESC",
        f"""SELECT data, patamar, inicio_patamar, codigo_usina, nome_usina, previsao_mwmed, programado_mwmed, {READABLE},
  ingerido_em AS confirmado_em FROM hist""",
    ),
    "observed_hours": _with(OBSERVED) + f"""SELECT ponto_id, uf, tipo_ponto, data_hora, {WEATHER}, {BLANK_WEATHER},
  make_timestamp(max(newest) OVER (PARTITION BY ponto_id, dia)) AS ingerido_em FROM obs""",
    "forecast_hours": FORECAST_HOURS,
    "capacity_factor_monthly": _with(CAPACITY, MONTHLY) + f"""SELECT mes, uf, tipo_usina, usinas,
  geracao_verificada_mwh, geracao_programada_mwh,
  capacidade_mwh, {RATIO.format('geracao_verificada_mwh', 'capacidade_mwh')} AS fator_capacidade,
  {RATIO.format('geracao_programada_mwh', 'capacidade_mwh')} AS fator_capacidade_programado FROM monthly""",
    "shortfall_daily": _with(SCHEDULE, DAILY) + f"""SELECT data, usinas, previsto_mwh,
  programado_mwh, restricao_mwh,
  {RATIO.format('restricao_mwh', 'previsto_mwh')} AS restricao_pct, share AS meias_horas_com_restricao_pct FROM daily""",
    "shortfall_by_plant_monthly": _with(SCHEDULE, PLANTS) + f"""SELECT mes, codigo_usina, nome_usina, previsto_mwh,
  restricao_mwh, {RATIO.format('restricao_mwh', 'previsto_mwh')} AS restricao_pct FROM plants""",
    "schedule_error_monthly": _with(CAPACITY, ERRORS) + f"""SELECT mes, uf, tipo_usina, geracao_programada_mwh,
  geracao_verificada_mwh, erro_absoluto_mwh,
  {RATIO.format('erro_absoluto_mwh', 'geracao_verificada_mwh')} AS erro_relativo,
  {RATIO.format('(geracao_verificada_mwh - geracao_programada_mwh)', 'geracao_programada_mwh')} AS vies_relativo FROM errors""",
    "weather_and_generation": _with(CAPACITY, OBSERVED, JOINED) + """SELECT data_hora, uf, tipo_usina, ponto_id,
  g AS geracao_verificada_mwmed, c AS capacidade_mw, f AS fator_capacidade, vento_100m_ms,
  radiacao_solar_wm2, cobertura_nuvens_pct,
  temperatura_c, precipitacao_mm FROM wg""",
    "power_curve": _with(CAPACITY, OBSERVED, JOINED, CURVE) + """SELECT tipo_usina, variavel, faixa_inicio, faixa_fim, horas,
  fator_capacidade, p25 AS fator_capacidade_p25, p75 AS fator_capacidade_p75 FROM curve""",
    "weather_correlation": _with(CAPACITY, OBSERVED, JOINED, CORRELATION) + """SELECT uf, tipo_usina, variavel,
  round(correlacao, 6) AS correlacao, horas FROM corrs""",
    "weather_accuracy": _with(FORECAST, OBSERVED, ACCURACY) + "SELECT * FROM acc",
    "load_and_temperature": _with(LOAD, OBSERVED, HEAT) + """SELECT data, carga_mwmed, temperatura_media_c,
  temperatura_maxima_c, CAST(isodow(data) AS INTEGER) AS dia_semana, isodow(data) >= 6 AS fim_de_semana FROM heat""",
    "report_headlines": _with(CAPACITY, MONTHLY, SCHEDULE, DAILY, OBSERVED, JOINED, CORRELATION, FORECAST, ACCURACY) + f"""FROM (
  SELECT {_percent(*GENERATED, "tipo_usina = 'Eólica' AND month(mes) IN (7, 8, 9, 10)")} AS fator_eolico_safra_pct,
    {_percent(*GENERATED, "tipo_usina = 'Eólica' AND month(mes) IN (1, 2, 3, 4)")} AS fator_eolico_entressafra_pct FROM monthly),
  (SELECT round(sum(restricao_mwh) / 1000000, 1) AS restricao_twh FROM daily),
  (SELECT round(avg(correlacao) FILTER (variavel = 'vento_100m_ms'), 2) AS correlacao_vento FROM corrs),
  (SELECT round(avg(erro_medio_absoluto_vento_100m_kmh), 1) AS erro_previsao_vento_kmh FROM acc)""",
    "report_capacity_by_month": _with(CAPACITY, MONTHLY)
    + f"SELECT mes, tipo_usina, {_percent(*GENERATED)} AS fator_pct FROM monthly GROUP BY ALL",
    "report_capacity_by_state": _with(CAPACITY, MONTHLY)
    + f"SELECT uf, tipo_usina, {_percent(*GENERATED)} AS fator_pct FROM monthly GROUP BY ALL",
    "report_wind_curve": _with(CAPACITY, OBSERVED, JOINED, CURVE) + """SELECT faixa_inicio AS vento_ms,
  round(fator_capacidade * 100, 1) AS fator_pct, horas FROM curve WHERE tipo_usina = 'Eólica' AND horas >= 100""",
    "report_solar_curve": _with(CAPACITY, OBSERVED, JOINED, CURVE) + """SELECT faixa_inicio AS radiacao_wm2,
  round(fator_capacidade * 100, 1) AS fator_pct, horas FROM curve WHERE tipo_usina = 'Solar' AND horas >= 100""",
    "report_main_correlations": _with(CAPACITY, OBSERVED, JOINED, CORRELATION) + """SELECT uf, tipo_usina || ': ' ||
  CASE variavel WHEN 'vento_100m_ms' THEN 'vento a 100 m' ELSE 'radiação' END AS relacao, round(correlacao, 2) AS correlacao
  FROM corrs WHERE variavel IN ('vento_100m_ms', 'radiacao_solar_wm2')""",
    "report_shortfall_by_month": _with(SCHEDULE, DAILY) + f"""SELECT CAST(date_trunc('month', data) AS DATE) AS mes,
  round(sum(restricao_mwh) / 1000, 0) AS restricao_gwh, {_percent("restricao_mwh", "previsto_mwh")} AS restricao_pct
  FROM daily WHERE data <= DATE '2001-02-28' GROUP BY ALL""",
    "report_most_limited_plants": _with(SCHEDULE, PLANTS) + """SELECT nome_usina, round(sum(restricao_mwh) / 1000, 1) AS restricao_gwh
  FROM plants GROUP BY 1 ORDER BY restricao_gwh DESC, nome_usina LIMIT 10""",
    "report_schedule_error": _with(CAPACITY, ERRORS)
    + f"SELECT mes, tipo_usina, {_percent('erro_absoluto_mwh', 'geracao_verificada_mwh')} AS erro_pct FROM errors GROUP BY ALL",
    "report_forecast_error": _with(FORECAST, OBSERVED, ACCURACY) + """SELECT ponto_id,
  round(avg(erro_medio_absoluto_vento_100m_kmh), 1) AS erro_vento_kmh, round(avg(vento_100m_observado_kmh), 1) AS vento_medio_kmh
  FROM acc GROUP BY 1""",
    "report_load_and_heat": _with(LOAD, OBSERVED, HEAT) + """SELECT round(temperatura_media_c, 6) AS temperatura_media_c,
  round(carga_mwmed / 1000, 2) AS carga_gwmed, CASE WHEN isodow(data) >= 6 THEN 'Fim de semana' ELSE 'Dia útil' END AS tipo_dia FROM heat""",
    "monitor_summary": _with(LOAD, CAPACITY, SCHEDULE) + f"""SELECT
  (SELECT count(*) FROM events WHERE {SECOND} >= TIMESTAMP '2024-01-01') AS execucoes_ingestao,
  (SELECT count(*) FROM events WHERE {SECOND} >= TIMESTAMP '2024-01-01' AND event_type = 'error') AS falhas_ingestao,
  (SELECT count(*) FROM load_all WHERE subsistema IS NULL OR carga_mwmed IS NULL)
    + 2 * (SELECT count(*) FROM cap_all WHERE subsistema IS NULL)
    + (SELECT count(*) FROM sch_all WHERE patamar > 48) AS registros_em_quarentena""",
    "monitor_rows_per_day": f"""SELECT CAST({LOCAL.format(SECOND)} AS DATE) AS dia, event_type AS notebook,
  CAST(sum(user_id) AS BIGINT) AS linhas FROM events
  WHERE event_type <> 'error' AND {SECOND} >= TIMESTAMP '2024-01-01' GROUP BY ALL""",
    "monitor_latest_runs": f"""SELECT {LOCAL.format(SECOND)} AS inicio_brasilia, event_type AS notebook,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, user_id AS linhas_gravadas,
  round(value, 6) AS duracao_segundos, CASE WHEN event_type = 'error' THEN props END AS erro
  FROM events ORDER BY {SECOND} DESC, event_type LIMIT 50""",
    "monitor_update_runs": _with(EVENT_LOG) + f"""SELECT CASE WHEN event_type = 'view' THEN 'silver' ELSE 'gold' END AS camada,
  {LOCAL.format('min(t)')} AS inicio_brasilia, round((epoch_ms(max(t)) - epoch_ms(min(t))) / 60000, 1) AS duracao_min,
  max_by(state, t) AS estado FROM log WHERE NOT is_quality AND t >= TIMESTAMP '2024-01-01' GROUP BY event_type, user_id""",
    "monitor_rule_totals": _with(EVENT_LOG) + """SELECT event_type AS tabela, 'valor_alto' AS regra,
  CAST(sum(user_id) AS BIGINT) AS aprovados, CAST(sum(k) AS BIGINT) AS reprovados FROM log WHERE is_quality AND value > 10 GROUP BY 1""",
    "latest_per_key": _with(LEVELS) + """SELECT * FROM levels QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, level DESC, event_id DESC) = 1""",
    "change_history": _levels("user_id, event_type", "SELECT user_id, event_type, ts, level, event_id, start_at, end_at FROM hist"),
    "stream_keyed_state": _levels("user_id, event_type", "SELECT user_id, event_type, ts, level, event_id, start_at, end_at FROM hist"),
    "change_history_long_keys": _levels("event_type", "SELECT user_id, event_type, ts, level, event_id, start_at, end_at FROM hist"),
    "readable_versions": _levels(
        "user_id, event_type", f"SELECT user_id, event_type, level, event_id, {READABLE}, ts AS confirmado_em FROM hist"
    ),
    "revision_stats": _levels("user_id, event_type", """, moves AS (SELECT *, lag(level) OVER w AS old_level,
  lag(start_at) OVER w AS old_start FROM hist WINDOW w AS (PARTITION BY user_id, event_type ORDER BY start_at))
SELECT event_type, count(*) AS revisions, round(avg(level - old_level), 6) AS mean_change,
  round(avg(abs(level - old_level)), 6) AS mean_absolute_change,
  round(max((epoch_ms(start_at) - epoch_ms(old_start)) / 60000 / 1440), 6) AS longest_delay_days
FROM moves WHERE old_start IS NOT NULL GROUP BY 1"""),
    "rules_mark": f"SELECT event_id, {VIOLATED} AS regras_violadas FROM events",
    "rules_pass": f"SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events WHERE {EVENT_OK}",
    "rules_quarantine": f"""SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props, {VIOLATED} AS regras_violadas
  FROM events WHERE NOT ({EVENT_OK})""",
    "rules_counts": _counts("events", "events", EVENT_RULES, {"long_props": "nullif(value, 6.55) < 100"}),
    "response_curve": """WITH b AS (SELECT event_type, value, value / 500 AS rate,
  CASE WHEN event_type = 'view' THEN 10.0::DOUBLE ELSE 25.0::DOUBLE END AS w FROM events)
SELECT event_type, floor(value / w) * w AS bin_start, floor(value / w) * w + w AS bin_end, count(*) AS n,
  round(sum(value) / sum(500.0::DOUBLE), 6) AS weighted, round(quantile_disc(rate, 0.25), 6) AS p25,
  round(quantile_disc(rate, 0.75), 6) AS p75 FROM b GROUP BY ALL""",
    "correlation_by_group": """WITH e AS (SELECT event_type, value, CAST(user_id AS DOUBLE) AS u,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_type, 'user' AS variable, round(corr(u, value), 6) AS correlation, count(*) AS n FROM e GROUP BY 1
UNION ALL SELECT event_type, 'k', round(corr(k, value), 6), count(*) FROM e WHERE value > 20 GROUP BY 1
UNION ALL SELECT event_type, 'constant', NULL, count(*) FROM e GROUP BY 1""",
    "forecast_accuracy": _with(HOURLY) + """SELECT CAST(p.hour AS DATE) AS day, count(*) AS hours, round(avg(abs(p.x - o.x)), 6) AS mae,
  round(avg(p.x - o.x), 6) AS bias, round(avg(abs(p.x - o.x)) FILTER (o.x > 20), 6) AS mae_high
  FROM hourly p JOIN hourly o ON p.hour = o.hour AND p.event_type = 'view' AND o.event_type = 'click' GROUP BY 1""",
    "join_match_report": _with(HOURLY) + """SELECT
  (SELECT count(*) FROM hourly p JOIN hourly o ON p.hour = o.hour AND p.event_type = 'view' AND o.event_type = 'click') AS joined_rows,
  (SELECT count(*) FROM hourly WHERE event_type = 'view' AND hour NOT IN (SELECT hour FROM hourly WHERE event_type = 'click')) AS left_unmatched,
  (SELECT count(*) FROM hourly WHERE event_type = 'click' AND hour NOT IN (SELECT hour FROM hourly WHERE event_type = 'view')) AS right_unmatched""",
    "daily_pair_weekday": _with(PAIR_DAYS) + """SELECT day, round(bought, 6) AS bought, round(failed, 6) AS failed,
  CAST(isodow(day) AS INTEGER) AS weekday, isodow(day) >= 6 AS weekend FROM p""",
    "weekend_effect": _with(PAIR_DAYS) + """SELECT round(avg(bought) FILTER (isodow(day) < 6), 6) AS weekday_mean,
  round(avg(bought) FILTER (isodow(day) >= 6), 6) AS weekend_mean, round(corr(failed, bought), 6) AS correlation, count(*) AS days,
  round(avg(bought) FILTER (isodow(day) >= 6) / avg(bought) FILTER (isodow(day) < 6) - 1, 6) AS weekend_change FROM p""",
    "flatten_parallel_arrays": """SELECT event_type, date_trunc('hour', ts) AS hour, round(max(value), 6) AS high, round(min(value), 6) AS low,
  1.5::DOUBLE AS latitude FROM events GROUP BY ALL""",
    "responses_by_position": """SELECT c_mktsegment, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "array_positions": """SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, round(CAST(embedding[i] AS DOUBLE), 6) AS component
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "json_path_cast": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.none') AS "none" FROM events""",
    "vocabulary_normalize": """SELECT p_partkey, nullif(p_name, 'red widget') AS name, nullif(nullif(p_brand, 'Brand#2'), 'Brand#4') AS brand,
  CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promotion' END AS kind, 'Tipo ' || p_type AS mode,
  coalesce(nullif(p_brand, 'Brand#2'), '-') || ' | ' || p_name AS key, 'A' || p_type || 'CO' AS folded,
  lower(p_brand) || '-' || CASE p_type WHEN 'PROMO' THEN 'promo' ELSE 'other' END AS slug FROM part""",
    "recode_join": "SELECT c_custkey, c_nationkey AS code, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "half_hour_slot": """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber < 7
  THEN date_trunc('day', l_shipdate) + to_minutes((l_linenumber * 7 - 1) * 30) END AS slot_start FROM lineitem""",
    "type_conversions": """SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 6) END AS number,
  CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS day, date_trunc('minute', ts) AS hour, ts AS clock,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) = 1 AS is_one, CAST(user_id AS INTEGER) AS "user" FROM events""",
    "date_buckets": f"""SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(isodow(ts) AS INTEGER) AS weekday,
  isodow(ts) >= 6 AS weekend, CAST(CAST(ts AS DATE) - 1 AS DATE) AS issued, {LOCAL.format('ts')} AS local,
  month(ts) BETWEEN 1 AND 4 AS in_season FROM events""",
    "guarded_math": """WITH e AS (SELECT event_id, value, CAST(nullif(user_id, 8) AS DOUBLE) AS lim FROM events)
SELECT event_id, round(CASE WHEN lim - 20 > 0 THEN value / (lim - 20) END, 6) AS ratio, round(greatest(value - lim, 0), 6) AS shortfall,
  CAST(value - lim > 0.5 AS INTEGER) AS exceeds, round(abs(value - lim), 6) AS error,
  round(CASE WHEN lim > 0 THEN (value - lim) / lim END, 6) AS relative, round(floor((value - 20) / 7.5) * 7.5, 6) AS bin,
  round(CASE WHEN value > 30 THEN value END, 6) AS high FROM e""",
    "align_schema": """SELECT event_id, CASE WHEN event_type <> 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
  CAST(user_id AS INTEGER) AS user_id FROM events""",
    "conversion_losses": "SELECT count(*) FILTER (event_type = 'view') AS value, count(*) AS user_id FROM events",
    "trailing_window": ORDERS + "CAST(o_orderdate AS DATE) BETWEEN DATE '1998-05-16' AND DATE '1998-07-15'",
    "lagged_window": ORDERS + "CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-29' AND DATE '1998-07-05'",
    "closed_month": ORDERS + "date_trunc('month', o_orderdate) = DATE '1998-06-01'",
    "single_day": ORDERS + "CAST(o_orderdate AS DATE) = DATE '1998-07-14'",
    "backfill_months": ORDERS + "date_trunc('month', o_orderdate) IN (DATE '1997-02-01', DATE '1997-03-01', DATE '1998-12-01')",
    "backfill_periods": """WITH a AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1),
m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', lo), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS mo FROM a)
SELECT o_custkey, greatest(mo, lo) AS block_start, least(last_day(mo), hi) AS block_end FROM m""",
    "clone_reconcile": "SELECT 'orders' AS \"table\", count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM orders",
    "append_with_metadata": """SELECT event_id, round(value, 6) AS value, CASE WHEN event_type = 'view' THEN user_id END AS user_id,
  TIMESTAMP '2024-01-31' AS ingestion_timestamp, CASE WHEN event_type = 'view' THEN 'two' ELSE 'one' END AS source,
  CAST(count(*) OVER (PARTITION BY event_type = 'view') AS INTEGER) AS rows_written FROM events""",
    "yearly_files": ORDERS + "CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-10' AND DATE '1998-07-15'",
    "yearly_files_mixed_types": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderdate,
  CASE WHEN year(o_orderdate) = 1998 THEN 'new' END AS remark FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-10' AND DATE '1998-07-15'""",
    "table_differences": """SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'missing' ELSE 'changed' END AS difference,
  CAST(1 AS BIGINT) AS left_rows, CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 1 END AS BIGINT) AS right_rows
  FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 AND o_orderstatus <> 'X'
UNION ALL SELECT -o_orderkey - 1, 'added', 0, 1 FROM orders WHERE o_orderkey % 101 = 0""",
    "snapshot_refresh": "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
    "csv_round_trip": "SELECT n_name, count(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1",
    "audited_runs": """SELECT 'customers' AS pipeline_name, '1998-07-15' AS data_referencia, 'success' AS status,
  count(*) AS linhas_gravadas, false AS has_error FROM customer
UNION ALL SELECT 'broken', '1998-07-15', 'failed', CAST(0 AS BIGINT), true""",
    "top10": """SELECT s_name, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name ORDER BY quantity DESC, s_name LIMIT 10""",
    "latest50": "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events ORDER BY ts DESC, event_id LIMIT 50",
    "centroid_share": """WITH p AS (SELECT n_regionkey, n_name, s_acctbal AS w, CAST(s_suppkey AS DOUBLE) AS x, CAST(n_nationkey AS DOUBLE) AS y
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT n_regionkey, n_name, sum(w) AS total, sum(x * w) / sum(w) AS x, sum(y * w) / sum(w) AS y FROM p GROUP BY ALL)
SELECT n_regionkey, n_name, round(total, 6) AS total, round(x, 6) AS x, round(y, 6) AS y,
  round(CASE WHEN sum(total) OVER r > 0 THEN total / sum(total) OVER r END, 6) AS share FROM g WINDOW r AS (PARTITION BY n_regionkey)""",
    "key_candidates": " UNION ALL ".join(
        f"SELECT '{' + '.join(c)}' AS candidate, {len(c)} AS columns, count(DISTINCT ({', '.join(c)})) AS distinct_rows, "
        f"count(*) AS rows, count(DISTINCT ({', '.join(c)})) = count(*) AS is_key FROM lineitem"
        for c in (("l_orderkey",), ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    ),
    "smallest_key": " UNION ALL ".join(
        f"SELECT '{c}' AS candidate, 1 AS columns, count(DISTINCT {c}) AS distinct_rows, count(*) AS rows, true AS is_key FROM events "
        f"HAVING count(DISTINCT {c}) = count(*)"
        for c in ("event_type", "event_id", "ts")
    ),
    "natural_keys": _natural_keys("lineitem", LINE_COLUMNS),
    "column_profile": _profile(
        "(SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate), nullif(l_returnflag, 'N') AS flag, l_linenumber - 4 AS \"offset\" FROM lineitem)",
        (*LINE_COLUMNS, "flag", "offset"), {"l_returnflag", "l_linestatus", "l_shipdate", "flag"},
    ),
    "duplicate_classes": """SELECT l_suppkey, l_shipdate, count(*) AS copies, count(DISTINCT l_linestatus) AS batches,
  CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'apparent' WHEN count(DISTINCT l_linestatus) > 1 THEN 'reingested' ELSE 'technical' END AS class
  FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "derived_check": """WITH l AS (SELECT abs(l_quantity / 50 - l_quantity * (1 - l_discount) / 50) AS gap FROM lineitem)
SELECT count(*) AS rows, count(*) FILTER (gap > 0.025) AS mismatches, count(*) FILTER (gap IS NULL) AS not_comparable,
  round(max(gap), 6) AS largest_gap FROM l""",
}

# Refreshing months gives what one computation over all rows gives.
ORACLE["metrics_by_changed_months"] = ORACLE["capacity_factor_monthly"]


def _dependencies(columns: list[str], source: str) -> str:
    """All least determinants of one or two columns, by comparing distinct counts."""
    single, pair = "(SELECT DISTINCT {} FROM t)", "SELECT '{}' AS determinant, '{}' AS dependent, (SELECT count(*) FROM {}) AS classes WHERE {}"
    holds = lambda x, a: f"(SELECT count(*) FROM {single.format(', '.join(x))}) = (SELECT count(*) FROM {single.format(', '.join([*x, a]))})"
    parts = []
    for size in (1, 2):
        for x in combinations(sorted(columns), size):
            for a in sorted(set(columns) - set(x)):
                least = "" if size == 1 else "".join(f" AND NOT {holds([one], a)}" for one in x)
                parts.append(pair.format(",".join(x), a, single.format(", ".join(x)), holds(x, a) + least))
    return f"WITH t AS ({source}) " + " UNION ALL ".join(parts)


ORACLE["column_dependencies"] = _dependencies(
    ["c_custkey", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey"], "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey"
)
ORACLE["quantiles_of_months"] = """SELECT event_type, CAST(share AS DOUBLE) AS share, count(*) AS rows, true AS within
FROM events, (VALUES (0.25), (0.5), (0.75)) AS shares(share) WHERE value IS NOT NULL GROUP BY event_type, share"""

ORACLE["distinct_customers_of_years"] = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT CAST(o_orderdate AS VARCHAR) || '|' || o_orderpriority) AS day_priorities
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""
