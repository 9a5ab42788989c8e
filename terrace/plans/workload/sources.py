"""The star-schema tables in the raw layouts of the energy sources.

Nothing is invented: every raw row derives from a row of the given tables, with
the defects the raw sources have (blank padding, unknown codes, text that is not a
number, slots outside the day), so cleaning and rules have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.sinks import INGESTED_AT

REGION_CODES = {"ASIA": " ne ", "AFRICA": "N", "AMERICA": "s", "EUROPE": "SE", "MIDDLE EAST": "XX"}
FLAG_KINDS = {"A": "EOLIELÉTRICA", "R": " Fotovoltaica", "N": "TÉRMICA"}
FLAG_POINTS = {"A": "eolica", "R": "solar", "N": "capital"}
PRIORITY_CODES = {"1-URGENT": "N", "2-HIGH": "NE", "3-MEDIUM": "S", "4-NOT SPECIFIED": "SE", "5-LOW": "XX"}
NOT_A_NUMBER = "n/d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def coded(value: str, codes: dict[str, str]) -> Column:
    case = None
    for known, code in codes.items():
        case = (F if case is None else case).when(F.col(value) == known, F.lit(code))
    return case


def _ingested() -> Column:
    """A distinct, order-preserving ingestion instant per line."""
    return F.timestamp_micros(F.col("l_orderkey") * 8 + F.col("l_linenumber"))


def _hour() -> Column:
    return F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))


def _sixteenths(value: str) -> Column:
    """Whole percents as sixteenths: sums of them are exact in any order, on any engine."""
    return F.round(F.col(value) * 100) / 16


def _delivered() -> Column:
    """Quantity less the discount."""
    return F.col("l_quantity") - _sixteenths("l_discount")


def _text(value: Column) -> Column:
    """Number as text; lines of the highest tax carry text that is no number."""
    return F.when(F.col("l_tax") == 0.08, F.lit(NOT_A_NUMBER)).otherwise(value.cast("string"))


def lines_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the supplier's nation and region.

    Dimensions join one after the other, each a plain scan whose size Spark knows,
    so it broadcasts those below its threshold and shuffles the others.
    """
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def raw_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.lit("  ")
    return lines_by_place(spark, sf_dir).select(
        coded("r_name", REGION_CODES).alias("id_subsistema"),
        F.col("r_name").alias("nom_subsistema"),
        F.lower("n_name").alias("id_estado"),
        F.col("n_name").alias("nom_estado"),
        blank.alias("cod_pontoconexao"),
        blank.alias("nom_pontoconexao"),
        F.concat(F.lit(" "), F.col("r_name")).alias("nom_localizacao"),
        (F.col("s_acctbal") / 1000).alias("val_latitudesecoletora"),
        (F.col("s_acctbal") / -500).alias("val_longitudesecoletora"),
        F.lit(None).cast("double").alias("val_latitudepontoconexao"),
        F.lit(None).cast("double").alias("val_longitudepontoconexao"),
        F.lit("TIPO II-B").alias("nom_modalidadeoperacao"),
        coded("l_returnflag", FLAG_KINDS).alias("nom_tipousina"),
        F.col("s_name").alias("nom_usina_conjunto"),
        F.col("l_suppkey").cast("string").alias("id_ons"),
        F.lit("-").alias("ceg"),
        _hour().cast("timestamp").alias("din_instante"),
        F.col("l_quantity").cast("string").alias("val_geracaoprogramada"),
        _text(_delivered()).alias("val_geracaoverificada"),
        F.lit("50.0").alias("val_capacidadeinstalada"),
        (_delivered() / 50).alias("val_fatorcapacidade"),
        _ingested().alias(INGESTED_AT),
    )


def raw_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_by_place(spark, sf_dir).select(
        _hour().cast("timestamp").alias("din_instante"),
        coded("r_name", REGION_CODES).alias("id_subsistema"),
        F.col("r_name").alias("nom_subsistema"),
        F.lower("n_name").alias("id_estado"),
        F.col("n_name").alias("nom_estado"),
        F.when(F.col("l_linestatus") == "O", F.lit("tipo iii")).otherwise(F.lit(" Pequenas Usinas ")).alias(
            "cod_modalidadeoperacao"
        ),
        coded("l_returnflag", FLAG_KINDS).alias("nom_tipousina"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("nom_tipocombustivel"),
        F.concat(F.lit(" "), F.col("s_name")).alias("nom_usina"),
        F.lit("").alias("id_ons"),
        F.when(F.col("l_returnflag") == "N", F.lit("-")).when(F.col("l_returnflag") == "R", F.lit("CEG.1")).alias("ceg"),
        (F.col("l_quantity") - 12).alias("val_geracao"),
        _ingested().alias(INGESTED_AT),
    )


def raw_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots run from 7 to 49; the last lies outside the day."""
    return table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("dat_programacao"),
        (F.col("l_linenumber") * 7).alias("num_patamar"),
        F.concat(F.lit(" U"), F.col("l_suppkey"), F.lit("   ")).alias("cod_usinapdp"),
        F.concat(F.lit("Plant "), F.col("l_suppkey"), F.lit("  ")).alias("nom_usinapdp"),
        _text(F.col("l_quantity")).alias("val_previsao"),
        _delivered().cast("string").alias("val_programado"),
        _ingested().alias(INGESTED_AT),
    )


def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings: several per subsystem and day, so values get revised."""
    return table(spark, sf_dir, "orders").select(
        coded("o_orderpriority", PRIORITY_CODES).alias("id_subsistema"),
        F.col("o_orderpriority").alias("nom_subsistema"),
        F.col("o_orderdate").cast("timestamp").alias("din_instante"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 100000).cast("double")).alias(
            "val_cargaenergiamwmed"
        ),
        F.timestamp_micros("o_orderkey").alias(INGESTED_AT),
    )


def _weather_hours(spark: SparkSession, sf_dir: str, pick, groups: list[Column]) -> DataFrame:
    """Hourly weather by point: one value per variable, picked from the lines of the hour."""
    return (
        lines_by_place(spark, sf_dir)
        .groupBy(
            F.concat(F.lower("n_name"), F.lit("-"), coded("l_returnflag", FLAG_POINTS)).alias("ponto_id"),
            F.col("n_name").alias("uf"),
            coded("l_returnflag", FLAG_POINTS).alias("tipo_ponto"),
            F.to_date("l_shipdate").alias("day"),
            F.date_format(_hour(), "yyyy-MM-dd'T'HH:mm").alias("time"),
            *groups,
        )
        .agg(
            pick("l_quantity").alias("wind_speed_100m"),
            (F.round(pick("l_discount") * 100) * 100).alias("shortwave_radiation"),
            (F.round(pick("l_tax") * 100) * 10).alias("cloud_cover"),
            (pick("l_quantity") / 2 + 10).alias("temperature_2m"),
            pick("l_linenumber").cast("double").alias("precipitation"),
            F.max("l_orderkey").alias("_newest"),
        )
    )


SERIES = ("wind_speed_100m", "shortwave_radiation", "cloud_cover", "temperature_2m", "precipitation")


def _responses(hours: DataFrame, groups: list[str], suffix: str = "") -> DataFrame:
    """Pack the hours of a point and day (24 at most) into one JSON response of parallel arrays."""
    packed = hours.groupBy("ponto_id", "uf", "tipo_ponto", "day", *groups).agg(
        F.array_sort(F.collect_list(F.struct("time", *SERIES))).alias("h"), F.max("_newest").alias("_newest")
    )
    response = F.struct(
        F.lit(-11.5).alias("latitude"),
        F.lit(-41.5).alias("longitude"),
        F.struct(F.col("h.time").alias("time"), *[F.col(f"h.{s}").alias(f"{s}{suffix}") for s in SERIES]).alias("hourly"),
    )
    return packed.withColumn("raw_response", F.to_json(response)).withColumn(INGESTED_AT, F.timestamp_micros("_newest"))


def raw_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = _responses(_weather_hours(spark, sf_dir, F.max, []), [])
    return responses.select("ponto_id", "uf", "tipo_ponto", "raw_response", INGESTED_AT)


def raw_forecasts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(daily captures, back-filled forecasts of solar points of the day before); together all lines."""
    horizon = F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("bigint").alias("horizonte_dias")
    hours = _weather_hours(spark, sf_dir, F.min, [horizon])
    backfilled = (F.col("tipo_ponto") == "solar") & (F.col("horizonte_dias") == 1)
    daily = _responses(hours.filter(~backfilled), ["horizonte_dias"])
    previous = _responses(hours.filter(backfilled), ["horizonte_dias"], "_previous_day1")
    common = ["ponto_id", "uf", "tipo_ponto", "horizonte_dias", "raw_response", INGESTED_AT]
    issued = F.date_sub(F.col("day"), F.col("horizonte_dias").cast("int")).cast("string")
    return (
        daily.select(*common, issued.alias("data_referencia"), F.col("day").cast("string").alias("data_prevista")),
        previous.select(*common),
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ingestion runs."""
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("data_referencia"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("execution_timestamp"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("user_id").alias("linhas_gravadas"),
        F.col("value").alias("duracao_segundos"),
        F.when(failed, F.col("props")).alias("erro"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a pipeline's JSON event log: progress of updates and rule outcomes."""
    quality = F.col("event_type").isin("purchase", "signup")
    state = F.when(F.col("value") > 40, "COMPLETED").otherwise("RUNNING")
    progress = F.to_json(F.struct(F.struct(state.alias("state")).alias("update_progress")))
    dataset = F.concat(F.col("event_type"), F.when(F.col("value") > 10, "_validada").otherwise("_padronizada"))
    rule = F.struct(
        F.lit("valor_alto").alias("name"),
        dataset.alias("dataset"),
        F.col("user_id").alias("passed_records"),
        F.get_json_object("props", "$.k").cast("bigint").alias("failed_records"),
    )
    outcome = F.to_json(
        F.struct(F.struct(F.struct(F.array(rule).alias("expectations")).alias("data_quality")).alias("flow_progress"))
    )
    return table(spark, sf_dir, "events").select(
        F.when(quality, "flow_progress").otherwise("update_progress").alias("event_type"),
        F.struct(F.concat_ws("-", "event_type", "user_id").alias("update_id")).alias("origin"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(quality, outcome).otherwise(progress).alias("details"),
    )


