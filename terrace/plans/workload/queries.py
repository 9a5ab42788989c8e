"""One query per operator or dataset, over the star-schema test tables.

``(spark, sf_dir) -> DataFrame``. Results are tidied for comparison with SQL:
inexact doubles rounded to six places, instants as wall clock, arrays as text.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import dates, nested, numeric, text
from terrace.operators import dependencies, difference, history, metrics as m, profile, quality, sketches
from terrace.operators.flatten import explode_series
from terrace.plans.energy import clean, ingest, jobs, monitoring, reports, values as v
from terrace.plans.energy.catalog import METRIC_TABLES
from terrace.plans.runner import clean_batch, compute_metrics, refresh_changed
from terrace.plans.spec import SEQUENCE, VERSION_COLUMNS, VIOLATED, ContractError, check_definition, check_schema, dictionary
from terrace.plans.workload import sources as s
from terrace.session import scratch_path
from terrace.sources import align, audit, backfill, scans, sinks
from terrace.streaming import keyed
from terrace.streaming.apply import IncrementalTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Reference times of the reports and windows; the test tables cover 1995-2001 and 2024-01.
REFERENCE_DAY = dt.date(1998, 7, 15)
REPORT_DAY = dt.date(2001, 3, 10)
NOW = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
RULES = {"value_in_range": "value BETWEEN 5 AND 150", "not_error": "nullif(event_type, 'view') <> 'error'"}
WARNINGS = {"long_props": "nullif(value, 6.55) < 100"}


def tidy(df: DataFrame, places: int | None) -> DataFrame:
    shown = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value.cast("double") if places is None else F.round(value.cast("double"), places)
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def query(function: Query, places: int | None = 6) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # wall-clock casts rely on it
        return tidy(function(spark, sf_dir), places)

    QUERIES[function.__name__] = run
    return function


def exact(function: Query) -> Query:
    """A query over values whose sums are exact, so nothing needs rounding."""
    return query(function, None)


# --- clean tables: standardize, validate, current, history, versions ---------------------

RAW = {
    "carga_energia": (clean.LOAD, s.raw_load),
    "geracao_usina": (clean.GENERATION, s.raw_generation),
    "fator_capacidade": (clean.CAPACITY, s.raw_capacity),
    "previsao_programado": (clean.SCHEDULE, s.raw_schedule),
    "clima_observado": (clean.OBSERVED, s.raw_observed),
    "clima_previsao": (clean.FORECAST, s.raw_forecasts),
}


def standardized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    definition, raw = RAW[name]
    made = raw(spark, sf_dir)
    return definition.standardize(*(made if isinstance(made, tuple) else (made,)))


def valid(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return quality.keep_valid(standardized(spark, sf_dir, name), RAW[name][0].drop_rules)


def current(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return history.latest_per_key(valid(spark, sf_dir, name), RAW[name][0].key, SEQUENCE)


def held(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return quality.quarantine(standardized(spark, sf_dir, name), RAW[name][0].drop_rules, VIOLATED)


def counted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    definition = RAW[name][0]
    return quality.rule_counts(
        standardized(spark, sf_dir, name), definition.drop_rules, definition.warn_rules, name
    )


def past(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    definition = RAW[name][0]
    return history.change_history(valid(spark, sf_dir, name), definition.key, SEQUENCE, definition.versioned, number="_number")


def versions(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return history.with_business_names(past(spark, sf_dir, name), "_number", SEQUENCE, VERSION_COLUMNS)


@query
def load_current(spark, sf_dir):
    return current(spark, sf_dir, "carga_energia")


@query
def load_quarantine(spark, sf_dir):
    return held(spark, sf_dir, "carga_energia")


@query
def load_rule_counts(spark, sf_dir):
    return counted(spark, sf_dir, "carga_energia")


@query
def load_history(spark, sf_dir):
    return past(spark, sf_dir, "carga_energia").drop("_number").withColumnsRenamed(
        {history.START_AT: "start_at", history.END_AT: "end_at"}
    )


@query
def load_versions(spark, sf_dir):
    return versions(spark, sf_dir, "carga_energia")


@query
def generation_current(spark, sf_dir):
    return current(spark, sf_dir, "geracao_usina")


@query
def generation_versions(spark, sf_dir):
    return versions(spark, sf_dir, "geracao_usina").select(
        "data_hora", "chave_usina", "geracao_mwmed", *VERSION_COLUMNS
    )


@query
def capacity_current(spark, sf_dir):
    return current(spark, sf_dir, "fator_capacidade")


@query
def capacity_quarantine(spark, sf_dir):
    return held(spark, sf_dir, "fator_capacidade").select("data_hora", "id_ons", "uf", SEQUENCE, VIOLATED)


@query
def capacity_rule_counts(spark, sf_dir):
    return counted(spark, sf_dir, "fator_capacidade")


@query
def schedule_current(spark, sf_dir):
    return current(spark, sf_dir, "previsao_programado")


@query
def schedule_quarantine(spark, sf_dir):
    return held(spark, sf_dir, "previsao_programado")


@query
def schedule_versions(spark, sf_dir):
    return versions(spark, sf_dir, "previsao_programado")


@query
def observed_hours(spark, sf_dir):
    return current(spark, sf_dir, "clima_observado")


@query
def forecast_hours(spark, sf_dir):
    return current(spark, sf_dir, "clima_previsao")


# --- whole declarations: all objects of a table, contracts, dictionary --------------------------


@query
def clean_batch_objects(spark, sf_dir):
    """All objects that one call makes of the schedule: rows, different keys and last ingestion of each; rows and failures of each rule."""
    facts = []
    for name, rows in clean_batch(spark, clean.SCHEDULE, s.raw_schedule(spark, sf_dir)).items():
        last = next((c for c in (SEQUENCE, VERSION_COLUMNS[-1]) if c in rows.columns), None)
        if last is not None:
            keys = F.count_distinct(F.struct(*clean.SCHEDULE.key))
            facts.append(rows.agg(F.lit(name).alias("object"), F.count("*").alias("rows"), keys.alias("keys"), F.max(last).alias("last"),
                                  F.lit(None).cast("long").alias("failed")))
        else:
            facts.append(rows.select(F.concat_ws(" ", F.lit(name), "kind", "rule").alias("object"), (F.col("passed") + F.col("failed")).alias("rows"),
                                     F.lit(None).cast("long").alias("keys"), F.lit(None).cast("timestamp").alias("last"), "failed"))
    return functools.reduce(DataFrame.unionAll, facts)


@query
def unreadable_responses(spark, sf_dir):
    """Observed responses of which some arrive cut off or as an error message: the quarantine tells them apart from bad keys."""
    broken = F.unix_micros(INGEST) % 5
    response = F.when(broken == 0, F.substring("raw_response", 1, 60)).when(broken == 1, F.lit('{"error": true, "reason": "limit"}'))
    dated = F.when(broken == 2, F.regexp_replace("raw_response", "T0[1-4]:00", "T")).otherwise(F.col("raw_response"))
    raw = s.raw_observed(spark, sf_dir).withColumn("raw_response", F.coalesce(response, dated))
    return clean_batch(spark, clean.OBSERVED, raw)["clima_observado_quarentena"].select(
        "ponto_id", "uf", "tipo_ponto", "data_hora", "temperatura_c", "latitude_grade", SEQUENCE, VIOLATED
    )


@query
def contract_checks(spark, sf_dir):
    """Each clean table against its declaration: as made, without a column, and with one of another type."""
    checked = []
    for name, (definition, _) in RAW.items():
        check_definition(definition, spark)
        made = standardized(spark, sf_dir, name)
        first = definition.stored[0].name
        shapes = {"whole": made, "short": made.drop(first), "other": made.withColumn(first, F.struct(first))}
        for shape, rows in shapes.items():
            try:
                check_schema(rows, definition.stored, name)
            except ContractError:
                shapes[shape] = False
            else:
                shapes[shape] = True
        checked.append(made.agg(F.lit(name).alias("table"), F.count("*").alias("rows"), *[F.lit(h).alias(shape) for shape, h in shapes.items()]))
    return functools.reduce(DataFrame.unionAll, checked)


@query
def documented_columns(spark, sf_dir):
    """The dictionary of the load table beside what its rows hold."""
    told = dictionary(spark, [clean.LOAD]).filter(F.col("table") == clean.LOAD.name)
    held = profile.column_profile(current(spark, sf_dir, clean.LOAD.name))
    return told.join(held, "column").select(
        "layer", "table", "position", "column", "type", (F.length("comment") > 0).alias("documented"), "rows", "nulls"
    )


# --- metric tables and business reports ---------------------------------------------------


def metric(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One metric table with the inputs it needs, all as one lazy plan."""
    by_name = {t.name: t for t in METRIC_TABLES}
    wanted = [by_name[n] for n in (*by_name[name].metric_inputs, name)]
    return compute_metrics(wanted, lambda clean_name: current(spark, sf_dir, clean_name))[name]


@exact
def capacity_factor_monthly(spark, sf_dir):
    return metric(spark, sf_dir, "aproveitamento_mensal")


@exact
def shortfall_daily(spark, sf_dir):
    return metric(spark, sf_dir, "restricao_geracao_diaria")


@exact
def shortfall_by_plant_monthly(spark, sf_dir):
    return metric(spark, sf_dir, "restricao_geracao_por_usina")


@exact
def schedule_error_monthly(spark, sf_dir):
    return metric(spark, sf_dir, "precisao_programacao_mensal")


@exact
def weather_and_generation(spark, sf_dir):
    return metric(spark, sf_dir, "clima_x_geracao_horaria")


@exact
def power_curve(spark, sf_dir):
    return metric(spark, sf_dir, "curva_de_potencia")


@query
def weather_correlation(spark, sf_dir):
    return metric(spark, sf_dir, "correlacao_clima_geracao")


@exact
def weather_accuracy(spark, sf_dir):
    return metric(spark, sf_dir, "precisao_previsao_tempo")


@exact
def load_and_temperature(spark, sf_dir):
    return metric(spark, sf_dir, "carga_x_temperatura")


@query
def report_headlines(spark, sf_dir):
    return reports.headlines(
        metric(spark, sf_dir, "aproveitamento_mensal"),
        metric(spark, sf_dir, "restricao_geracao_diaria"),
        metric(spark, sf_dir, "correlacao_clima_geracao"),
        metric(spark, sf_dir, "precisao_previsao_tempo"),
    )


@query
def report_capacity_by_month(spark, sf_dir):
    return reports.capacity_by_month(metric(spark, sf_dir, "aproveitamento_mensal"))


@query
def report_capacity_by_state(spark, sf_dir):
    return reports.capacity_by_state(metric(spark, sf_dir, "aproveitamento_mensal"))


@query
def report_wind_curve(spark, sf_dir):
    return reports.wind_curve(metric(spark, sf_dir, "curva_de_potencia"))


@query
def report_solar_curve(spark, sf_dir):
    return reports.solar_curve(metric(spark, sf_dir, "curva_de_potencia"))


@query
def report_main_correlations(spark, sf_dir):
    return reports.main_correlations(metric(spark, sf_dir, "correlacao_clima_geracao"))


@query
def report_shortfall_by_month(spark, sf_dir):
    return reports.shortfall_by_month(metric(spark, sf_dir, "restricao_geracao_diaria"), F.lit(REPORT_DAY))


@query
def report_most_limited_plants(spark, sf_dir):
    return reports.most_limited_plants(metric(spark, sf_dir, "restricao_geracao_por_usina"))


@query
def report_schedule_error(spark, sf_dir):
    return reports.schedule_error_by_month(metric(spark, sf_dir, "precisao_programacao_mensal"))


@query
def report_forecast_error(spark, sf_dir):
    return reports.forecast_error_by_point(metric(spark, sf_dir, "precisao_previsao_tempo"))


@query
def report_load_and_heat(spark, sf_dir):
    return reports.load_and_heat(metric(spark, sf_dir, "carga_x_temperatura"))


# --- monitoring ---------------------------------------------------------------------------


@query
def monitor_summary(spark, sf_dir):
    return monitoring.summary(
        s.audit_log(spark, sf_dir), [held(spark, sf_dir, name) for name in RAW], F.lit(NOW)
    )


@query
def monitor_rows_per_day(spark, sf_dir):
    return monitoring.rows_per_day(s.audit_log(spark, sf_dir), F.lit(NOW))


@query
def monitor_latest_runs(spark, sf_dir):
    return monitoring.latest_runs(s.audit_log(spark, sf_dir))


@query
def monitor_update_runs(spark, sf_dir):
    log = s.event_log(spark, sf_dir)
    return monitoring.update_runs(
        [monitoring.progress_from_log(log.filter("origin.update_id LIKE 'view-%'"), "silver"),
         monitoring.progress_from_log(log.filter("origin.update_id NOT LIKE 'view-%'"), "gold")],
        F.lit(NOW),
    )


@query
def monitor_rule_totals(spark, sf_dir):
    return monitoring.rule_totals(monitoring.counts_from_log(s.event_log(spark, sf_dir)))


# --- operators on the event and order tables ------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.table(spark, sf_dir, "events")


def revisions_of_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as revisions of a level per user and kind."""
    return events(spark, sf_dir).select(
        "user_id", "event_type", "ts", F.floor(F.col("value") / 25).alias("level"), "event_id"
    )


@query
def latest_per_key(spark, sf_dir):
    return history.latest_per_key(revisions_of_level(spark, sf_dir), ["user_id", "event_type"], "ts")


@query
def change_history(spark, sf_dir):
    made = history.change_history(revisions_of_level(spark, sf_dir), ["user_id", "event_type"], "ts", ["level"])
    return made.withColumnsRenamed({history.START_AT: "start_at", history.END_AT: "end_at"})


@query
def change_history_long_keys(spark, sf_dir):
    """The same over one key per kind: every key is long, so all rows take the sliced way."""
    made = history.change_history(
        revisions_of_level(spark, sf_dir), ["event_type"], "ts", ["level"], long_key_rows=500
    )
    return made.withColumnsRenamed({history.START_AT: "start_at", history.END_AT: "end_at"})


@query
def readable_versions(spark, sf_dir):
    made = history.change_history(revisions_of_level(spark, sf_dir), ["user_id", "event_type"], "ts", ["level"])
    return history.readable_versions(made, ["user_id", "event_type"], "ts", VERSION_COLUMNS)


@query
def revision_stats(spark, sf_dir):
    keys = ["user_id", "event_type"]
    made = history.change_history(revisions_of_level(spark, sf_dir), keys, "ts", ["level"])
    return history.revision_summary(history.revisions(made, keys, "level"), ["event_type"])


@query
def rules_mark(spark, sf_dir):
    return quality.mark_violations(events(spark, sf_dir), RULES, VIOLATED).select("event_id", VIOLATED)


@query
def rules_pass(spark, sf_dir):
    return quality.keep_valid(events(spark, sf_dir), RULES)


@query
def rules_quarantine(spark, sf_dir):
    return quality.quarantine(events(spark, sf_dir), RULES, VIOLATED)


@query
def rules_counts(spark, sf_dir):
    return quality.rule_counts(events(spark, sf_dir), RULES, WARNINGS, "events")


@query
def response_curve(spark, sf_dir):
    kinds = events(spark, sf_dir).withColumn("capacity", F.lit(500.0)).withColumn("rate", F.col("value") / 500)
    width = F.when(F.col("event_type") == "view", F.lit(10.0)).otherwise(F.lit(25.0))
    return m.response_curve(
        kinds, ["event_type"], F.col("value"), width, "value", "capacity", "rate",
        ["bin_start", "bin_end", "n", "weighted", "p25", "p75"],
    )


@query
def correlation_by_group(spark, sf_dir):
    measured = events(spark, sf_dir).select(
        "event_type", "value", F.col("user_id").cast("double").alias("user"),
        nested.json_path("props", "$.k", "double").alias("k"), F.lit(0.1).alias("constant"),
    )
    always = F.lit(True)
    pairs = [(always, "user"), (F.col("value") > 20, "k"), (always, "constant")]
    return m.correlations(measured, ["event_type"], pairs, "value", ["variable", "correlation", "n"])


def hourly(spark: SparkSession, sf_dir: str, kind: str, name: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == kind)
        .groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour"))
        .agg(F.max("value").alias(name))
    )


@query
def forecast_accuracy(spark, sf_dir):
    paired = m.matched(hourly(spark, sf_dir, "view", "predicted"), hourly(spark, sf_dir, "click", "observed"), ["hour"])
    high = F.col("observed") > 20
    mae, bias = m.mean_errors(F.col("predicted"), F.col("observed"))
    high_mae, _ = m.mean_errors(numeric.only_if(high, "predicted"), numeric.only_if(high, "observed"))
    return paired.groupBy(F.to_date("hour").alias("day")).agg(
        F.count("*").alias("hours"), mae.alias("mae"), bias.alias("bias"), high_mae.alias("mae_high")
    )


@query
def join_match_report(spark, sf_dir):
    return m.match_report(
        hourly(spark, sf_dir, "view", "predicted"), hourly(spark, sf_dir, "click", "observed"), ["hour"]
    )


@query
def daily_pair_weekday(spark, sf_dir):
    day = lambda kind, name: hourly(spark, sf_dir, kind, "x").groupBy(F.to_date("hour").alias("day")).agg(
        F.max("x").alias(name)
    )
    paired = m.matched(day("purchase", "bought"), day("error", "failed"), ["day"])
    return paired.withColumns({"weekday": dates.iso_weekday("day"), "weekend": dates.is_weekend("day")})


@query
def weekend_effect(spark, sf_dir):
    return profile.weekend_effect(daily_pair_weekday(spark, sf_dir), "bought", "failed", "weekend")


@query
def flatten_parallel_arrays(spark, sf_dir):
    """Hourly values, 24 at most per kind and day, packed into one JSON response, then taken apart again."""
    hours = (
        events(spark, sf_dir)
        .groupBy("event_type", F.to_date("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:00").alias("time"))
        .agg(F.max("value").alias("high"), F.min("value").alias("low"))
    )
    packed = hours.groupBy("event_type", "day").agg(
        F.array_sort(F.collect_list(F.struct("time", "high", "low"))).alias("h")
    )
    series = F.struct(F.col("h.time").alias("time"), F.col("h.high").alias("high"), F.col("h.low").alias("low"))
    documents = packed.withColumn("payload", F.to_json(F.struct(F.lit(1.5).alias("latitude"), series.alias("hourly"))))
    keep = lambda c: c
    return explode_series(
        documents, "payload", [F.col("event_type")], {"high": keep, "low": keep}, {"high": "high", "low": "low"},
        scalars={"latitude": "latitude"},
    )


@query
def responses_by_position(spark, sf_dir):
    """One document per market segment with a response per region, paired with the regions by position."""
    located = s.table(spark, sf_dir, "customer").join(
        s.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = located.groupBy("c_mktsegment", "n_regionkey").agg(F.count("*").alias("n"))
    documents = counts.groupBy("c_mktsegment").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("n_regionkey", "n")))).alias("document")
    )
    regions = s.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("position"), "r_name")
    rows = scans.responses_by_position(documents, "document", "c_mktsegment", regions, "position", "raw")
    return rows.select("c_mktsegment", "r_name", nested.json_path("raw", "$.n", "bigint").alias("n"))


@query
def array_positions(spark, sf_dir):
    return s.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("position", "component"))


@query
def json_path_cast(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", nested.json_path("props", "$.k", "int").alias("k"), nested.json_path("props", "$.none").alias("none")
    )


@query
def vocabulary_normalize(spark, sf_dir):
    parts = s.table(spark, sf_dir, "part")
    return parts.select(
        "p_partkey",
        text.clean_text(F.concat(F.lit("  "), F.nullif(F.col("p_name"), F.lit("red widget")))).alias("name"),
        text.clean_text(F.nullif(F.col("p_brand"), F.lit("Brand#2")), ["Brand#4"]).alias("brand"),
        text.recode(text.clean_code(F.lower("p_type")), {"ECONOMY": "Economy", "PROMO": "Promotion"}).alias("kind"),
        text.title_prefix(F.concat(F.lit("tipo "), F.lower("p_type")), v.MODE_PREFIX, v.MODE_SHOWN).alias("mode"),
        text.joined_key(
            F.nullif(F.col("p_brand"), F.lit("Brand#2")), "p_name", separator=v.KEY_SEPARATOR, missing=["-", None]
        ).alias("key"),
        text.fold_accents(F.concat(F.lit("á"), F.col("p_type"), F.lit("çõ")), v.ACCENTED, v.PLAIN).alias("folded"),
        text.slug_key("p_brand", "p_type", {"PROMO": "promo"}, "other").alias("slug"),
    )


@query
def recode_join(spark, sf_dir):
    customers = s.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("code"))
    return text.recode_join(customers, "code", s.table(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation")


@query
def half_hour_slot(spark, sf_dir):
    return s.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        dates.slot_start(F.to_date("l_shipdate"), F.col("l_linenumber") * 7, 30).alias("slot_start"),
    )


@query
def type_conversions(spark, sf_dir):
    broken = F.when(F.col("event_type") == "error", F.lit("12,5")).otherwise(F.col("value").cast("string"))
    odd_day = F.when(F.col("event_type") == "view", F.lit("2024-xx")).otherwise(F.date_format("ts", "yyyyMMdd"))
    return events(spark, sf_dir).select(
        "event_id",
        dates.to_number(broken).alias("number"),
        dates.parse_day(odd_day).alias("day"),
        dates.parse_hour(F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("hour"),
        dates.wall_clock(F.col("ts").cast("timestamp")).alias("clock"),
        numeric.flag(nested.json_path("props", "$.k", "double")).alias("is_one"),
        F.col("user_id").cast("int").alias("user"),
    )


@query
def date_buckets(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        dates.month_start("ts").alias("month"),
        dates.iso_weekday("ts").alias("weekday"),
        dates.is_weekend("ts").alias("weekend"),
        dates.issue_day(F.to_date("ts"), 1).alias("issued"),
        dates.local_time(F.col("ts").cast("timestamp"), monitoring.DISPLAY_ZONE).alias("local"),
        dates.in_season("ts", 1, 4).alias("in_season"),
    )


@query
def guarded_math(spark, sf_dir):
    value, limit = F.col("value"), F.nullif(F.col("user_id"), F.lit(8)).cast("double")
    return events(spark, sf_dir).select(
        "event_id",
        numeric.ratio(value, limit - 20).alias("ratio"),
        numeric.shortfall(value, limit).alias("shortfall"),
        numeric.exceeds(value - limit, 0.5).alias("exceeds"),
        numeric.absolute_error(value, limit).alias("error"),
        numeric.relative_change(value, limit).alias("relative"),
        numeric.bin_start(value - 20, 7.5).alias("bin"),
        numeric.only_if(value > 30, value).alias("high"),
    )


@query
def align_schema(spark, sf_dir):
    arriving = events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") == "view", F.lit(" ")).otherwise(F.get_json_object("props", "$.k")).alias("k"),
        "user_id",
    )
    table = T.StructType().add("event_id", T.LongType()).add("k", T.DoubleType()).add("user_id", T.IntegerType())
    return align.align_to_schema(arriving, table)


@query
def conversion_losses(spark, sf_dir):
    arriving = events(spark, sf_dir).select(
        F.when(F.col("event_type") == "view", F.lit("n/d")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("event_type").alias("user_id"),
    )
    return align.conversion_losses(arriving, {"value": T.DoubleType(), "user_id": T.LongType()})


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")


@query
def trailing_window(spark, sf_dir):
    return orders(spark, sf_dir).filter(dates.in_day_window("o_orderdate", REFERENCE_DAY, 60))


@query
def lagged_window(spark, sf_dir):
    return orders(spark, sf_dir).filter(dates.in_day_window("o_orderdate", REFERENCE_DAY, 16, 10))


@query
def closed_month(spark, sf_dir):
    return orders(spark, sf_dir).filter(dates.in_closed_month("o_orderdate", REFERENCE_DAY))


@query
def single_day(spark, sf_dir):
    return orders(spark, sf_dir).filter(dates.on_lagged_day("o_orderdate", REFERENCE_DAY))


@query
def backfill_months(spark, sf_dir):
    months = backfill.closed_months_before([dt.date(1997, 3, 1), dt.date(1997, 4, 20), dt.date(1999, 1, 1)])
    return orders(spark, sf_dir).filter(backfill.in_months("o_orderdate", months))


@query
def backfill_periods(spark, sf_dir):
    """Each customer's active period cut into calendar months."""
    active = s.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    return backfill.month_blocks(active, "first_order", "last_order").select("o_custkey", "block_start", "block_end")


@query
def clone_reconcile(spark, sf_dir):
    """Orders cloned once into the shared folder, then both sides counted."""
    target = scratch_path(spark, "clone")
    sinks.clone_if_absent(spark, f"{sf_dir.rstrip('/')}/orders.parquet", target)
    return sinks.reconcile_counts({"orders": (s.table(spark, sf_dir, "orders"), spark.read.parquet(target))})


@query
def append_with_metadata(spark, sf_dir):
    """Two appends to a raw table: the second changes a type and brings a new column."""
    path = scratch_path(spark, "raw")
    first = events(spark, sf_dir).filter("event_type <> 'view'").select("event_id", "value")
    second = events(spark, sf_dir).filter("event_type = 'view'").select(
        "event_id", F.col("value").cast("string").alias("value"), "user_id"
    )
    written = [sinks.append_raw(part, path, label, NOW) for part, label in ((first, "one"), (second, "two"))]
    return sinks.read_raw(spark, path).withColumn("rows_written", F.when(F.col("source") == "one", written[0]).otherwise(written[1]))


@query
def yearly_files(spark, sf_dir):
    """Orders published as one file per year, read back as one scan; the current year is not out yet."""
    landing, years = scratch_path(spark, "years"), range(1995, 2003)
    orders(spark, sf_dir).withColumn("year", F.year("o_orderdate")).write.partitionBy("year").parquet(landing)
    files = {year: f"{landing}/year={year}" for year in years}
    return scans.read_years(spark, files, current_year=2002).filter(dates.in_day_window("o_orderdate", REFERENCE_DAY, 400))


@query
def yearly_files_mixed_types(spark, sf_dir):
    """Yearly files of which one has narrower keys and another has customers as text and a new column."""
    landing, made = scratch_path(spark, "years"), s.table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    rows = made.select("o_orderkey", "o_custkey", "o_orderdate", "year")
    rows.filter("year NOT IN (1997, 1998)").write.partitionBy("year").parquet(landing)
    rows.filter("year = 1997").withColumn("o_orderkey", F.col("o_orderkey").cast("int")).drop("year").write.parquet(f"{landing}/year=1997")
    texts = rows.filter("year = 1998").withColumns({"o_custkey": F.col("o_custkey").cast("string"), "remark": F.lit("new")})
    texts.drop("year").write.parquet(f"{landing}/year=1998")
    files = {year: f"{landing}/year={year}" for year in range(1995, 2003)}
    return scans.read_years(spark, files, current_year=2002).filter(dates.in_day_window("o_orderdate", REFERENCE_DAY, 400))


@query
def table_differences(spark, sf_dir):
    """Orders against a copy in which some rows are gone, some are new, and some have another status."""
    orders_now = s.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    copy = orders_now.filter(key % 97 != 0).withColumn("o_orderstatus", F.when(key % 89 == 0, "X").otherwise(F.col("o_orderstatus")))
    copy = copy.unionByName(orders_now.filter(key % 101 == 0).withColumn("o_orderkey", -key - 1))
    paths = [scratch_path(spark, "buckets") for _ in range(2)]
    for frame, path in zip((orders_now, copy), paths, strict=True):
        difference.write_buckets(frame, path, ["o_orderkey"])
    return difference.table_differences(*[spark.read.parquet(p) for p in paths], ["o_orderkey"])


@query
def snapshot_refresh(spark, sf_dir):
    """A table published twice; readers see the second version whole."""
    published = sinks.Snapshot(scratch_path(spark, "snapshot"))
    totals = s.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    published.refresh(totals.filter("o_orderpriority <> '5-LOW'"))
    return published.refresh(totals)


@query
def csv_round_trip(spark, sf_dir):
    target = scratch_path(spark, "csv")
    sinks.export_csv(s.table(spark, sf_dir, "nation").join(s.table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
                     .groupBy("n_name").agg(F.count("*").alias("n")), target)
    return spark.read.option("header", True).schema("n_name string, n bigint").csv(target)


@query
def audited_runs(spark, sf_dir):
    """An audited append, and one that fails on a lossy type change, as the audit log shows them."""
    log, path = scratch_path(spark, "audit"), scratch_path(spark, "audited")
    customers = s.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    with audit.audited_run(spark, log, "customers", REFERENCE_DAY) as run:
        run.rows = sinks.append_raw(customers, path, "workload", run.started_at)
    try:
        with audit.audited_run(spark, log, "broken", REFERENCE_DAY) as run:
            sinks.append_raw(customers.withColumn("c_custkey", F.col("c_mktsegment")), path, "workload", run.started_at)
    except align.LossyConversion:
        pass
    return spark.read.parquet(log).select(
        "pipeline_name", "data_referencia", "status", "linhas_gravadas", F.col("erro").isNotNull().alias("has_error")
    )


@query
def top10(spark, sf_dir):
    lines = s.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")
    )
    named = lines.join(s.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select("s_name", F.col("quantity").cast("double").alias("quantity")).orderBy(
        F.desc("quantity"), "s_name"
    ).limit(10)


@query
def latest50(spark, sf_dir):
    return events(spark, sf_dir).orderBy(F.desc("ts"), "event_id").limit(50)


@query
def centroid_share(spark, sf_dir):
    places = s.table(spark, sf_dir, "supplier").select("s_nationkey", F.col("s_acctbal").alias("weight"), "s_suppkey")
    nations = s.table(spark, sf_dir, "nation")
    located = places.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return profile.weighted_centroid(
        located, ["n_regionkey", "n_name"], ["n_regionkey"], "weight",
        {"x": F.col("s_suppkey").cast("double"), "y": F.col("n_nationkey").cast("double")}, "total", "share",
    )


CANDIDATES = (["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def key_candidates(spark, sf_dir):
    return profile.key_candidates(s.table(spark, sf_dir, "lineitem"), CANDIDATES)


@query
def smallest_key(spark, sf_dir):
    report = profile.key_candidates(events(spark, sf_dir), [["event_type"], ["user_id", "ts"], ["event_id"], ["ts"]])
    return profile.smallest_key(report)


@query
def natural_keys(spark, sf_dir):
    return profile.natural_keys(s.table(spark, sf_dir, "lineitem"), most_columns=2)


@query
def column_profile(spark, sf_dir):
    lines = s.table(spark, sf_dir, "lineitem").withColumns(
        {"l_shipdate": F.col("l_shipdate").cast("date"), "flag": F.nullif(F.col("l_returnflag"), F.lit("N")), "offset": F.col("l_linenumber") - 4}
    )
    return profile.column_profile(lines)


@query
def duplicate_classes(spark, sf_dir):
    readings = s.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", F.col("l_returnflag").alias("value"), F.col("l_linestatus").alias("batch")
    )
    return profile.duplicate_classes(readings, ["l_suppkey", "l_shipdate"], ["value"], "batch")


@query
def derived_check(spark, sf_dir):
    lines = s.table(spark, sf_dir, "lineitem").withColumn("stated", F.col("l_quantity") / 50)
    return profile.derived_check(lines, "stated", F.col("l_quantity") * (1 - F.col("l_discount")) / 50, 0.025)


@query
def column_dependencies(spark, sf_dir):
    """Customers with their nation and region in one flat table."""
    customers, nations = s.table(spark, sf_dir, "customer"), s.table(spark, sf_dir, "nation")
    flat = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return dependencies.column_dependencies(flat, ["c_custkey", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey"])


@query
def quantiles_of_months(spark, sf_dir):
    """Quantiles per kind of event from sketches of its months, with whether their true ranks are within 2 %."""
    rows = events(spark, sf_dir).withColumn("month", F.trunc("ts", "month"))
    whole = sketches.merged_sketches(sketches.quantile_sketches(rows, ["event_type", "month"], "value"), ["event_type"])
    told = sketches.rank_errors(rows, sketches.quantiles(whole, ["event_type"], [0.25, 0.5, 0.75]), ["event_type"], "value")
    return told.select("event_type", "share", "rows", (F.col("rank_error") <= 0.02).alias("within"))


@query
def distinct_customers_of_years(spark, sf_dir):
    """Exact distinct customers and days with orders per year, from what two increments kept of each month."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderpriority")
    rows = orders.withColumn("month", F.trunc("o_orderdate", "month")).withColumn("part", F.pmod(F.xxhash64("o_orderpriority"), F.lit(2)))
    kept, sets = scratch_path(spark, "bitmaps"), scratch_path(spark, "sets")
    for part in (0, 1):
        arrived = rows.filter(F.col("part") == part)
        sketches.id_bitmaps(arrived, ["month"], "o_custkey").write.mode("append").parquet(kept)
        sketches.key_sets(arrived, ["month"], ["o_orderdate", "o_orderpriority"]).write.mode("append").parquet(sets)
    by_year = lambda path: spark.read.parquet(path).withColumn("year", F.year("month"))
    customers = sketches.distinct_ids(by_year(kept), ["year"], "customers")
    return customers.join(sketches.distinct_keys(by_year(sets), ["year"], ["o_orderdate", "o_orderpriority"], "day_priorities"), "year")


# --- incremental upkeep -----------------------------------------------------------------------


def kept_by_stream(spark: SparkSession, sf_dir: str) -> IncrementalTable:
    """Load readings arrive in files out of order and are applied in several micro-batches."""
    landing = scratch_path(spark, "landing")
    raw = s.raw_load(spark, sf_dir)
    raw.repartition(6, F.hash(INGEST)).write.parquet(landing)
    state = IncrementalTable(clean.LOAD, scratch_path(spark, "state"))
    stream = scans.read_stream(spark, landing, spark.read.parquet(landing).schema, maxFilesPerTrigger="3")
    state.run_available(spark, stream)
    return state


INGEST = sinks.INGESTED_AT


@query
def stream_current(spark, sf_dir):
    return kept_by_stream(spark, sf_dir).current(spark)


@query
def stream_versions(spark, sf_dir):
    return kept_by_stream(spark, sf_dir).versions(spark)


@query
def stream_quarantine(spark, sf_dir):
    return kept_by_stream(spark, sf_dir).quarantine(spark)


@query
def stream_rule_counts(spark, sf_dir):
    counts = kept_by_stream(spark, sf_dir).rule_counts(spark)
    return counts.groupBy("table", "rule", "kind").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query
def stream_two_sources(spark, sf_dir):
    """Captured and back-filled forecasts, JSON in two streams, feed one table."""
    streams = []
    for rows in s.raw_forecasts(spark, sf_dir):
        landing = scratch_path(spark, "landing")
        rows.repartition(4, F.hash(INGEST)).write.parquet(landing)
        streams.append(scans.read_stream(spark, landing, spark.read.parquet(landing).schema, maxFilesPerTrigger="2"))
    state = IncrementalTable(clean.FORECAST, scratch_path(spark, "state"))
    state.run_available(spark, *streams)
    return state.current(spark)


@query
def stream_full_refresh(spark, sf_dir):
    """Raw load rows arrive in two appends and are applied; then the declared job rebuilds the table and takes the old one's place."""
    raw_root, clean_root = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    raw = s.raw_load(spark, sf_dir)
    early = F.pmod(F.hash(INGEST), F.lit(2)) == 0
    for part in (raw.filter(early), raw.filter(~early)):
        part.write.mode("append").parquet(ingest.raw_path(raw_root, clean.LOAD.raw_tables[0]))
        jobs.update_clean(spark, raw_root, clean_root, [clean.LOAD])
    jobs.update_clean(spark, raw_root, clean_root, [clean.LOAD], full=True)
    return jobs.clean_state(clean_root, clean.LOAD).versions(spark)


#: Days whose last closed months are the twelve of 1997.
BACKFILL_DAYS = [dt.date(1997 + (m == 12), m % 12 + 1, 5) for m in range(1, 13)]


@query
def backfill_job_mixed_types(spark, sf_dir):
    """A year of generation published by month: numbers in some files, texts in others; one job loads and audits all of them."""
    landing, raw_root = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    rows = s.raw_generation(spark, sf_dir).drop(INGEST)
    for month in backfill.closed_months_before(BACKFILL_DAYS):
        own = rows.filter(backfill.in_months("din_instante", [month]))
        kind = ("double", "string", "int")[month.month % 3]
        file = v.FEEDS["geracao"][3].format(month)
        own.withColumn("val_geracao", F.col("val_geracao").cast(kind)).write.parquet(f"{landing}/{file}")
    written = ingest.load_months(spark, "geracao", landing, raw_root, BACKFILL_DAYS)
    told = spark.read.parquet(ingest.audit_path(raw_root)).agg(F.sum("linhas_gravadas")).first()[0]
    loaded = sinks.read_raw(spark, ingest.raw_path(raw_root, "ons.geracao_usina"))
    return loaded.select(
        "din_instante", "nom_usina", "nom_tipousina", "val_geracao", F.lit(written).cast("long").alias("written"), F.lit(told).cast("long").alias("told")
    )


@query
def stream_keyed_state(spark, sf_dir):
    """Events arrive out of order in files; each key's versions are kept in state and changes are emitted."""
    keys, landing = ["user_id", "event_type"], scratch_path(spark, "landing")
    revisions_of_level(spark, sf_dir).repartition(4, F.hash("event_id")).write.parquet(landing)
    stream = scans.read_stream(spark, landing, spark.read.parquet(landing).schema, maxFilesPerTrigger="2")
    told = scratch_path(spark, "changes")
    keyed.run_keyed(keyed.version_changes(stream, keys, "ts", ["level"]), told, scratch_path(spark, "keyed-checkpoint"))
    made = keyed.versions_of(spark.read.parquet(told), keys, "ts")
    return made.withColumnsRenamed({history.START_AT: "start_at", history.END_AT: "end_at"})


@exact
def metrics_by_changed_months(spark, sf_dir):
    """Capacity rows in two batches, the second with rows of one year only; metrics are refreshed after each."""
    state = IncrementalTable(clean.CAPACITY, scratch_path(spark, "state"))
    rows = clean.CAPACITY.standardize(s.raw_capacity(spark, sf_dir))
    late = F.coalesce((F.year("data_hora") == 1997) & (F.pmod(F.hash("id_ons", "data_hora"), F.lit(3)) == 0), F.lit(False))
    wanted = [t for t in METRIC_TABLES if t.name in ("aproveitamento_mensal", "precisao_programacao_mensal")]
    root = scratch_path(spark, "metrics")
    for number, batch in enumerate((rows.filter(~late), rows.filter(late))):
        state.apply(batch, number)
        made = refresh_changed(spark, wanted, {"fator_capacidade": state}, root)
    return made["aproveitamento_mensal"]
