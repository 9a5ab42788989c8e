"""Business report datasets over the metric tables.

Each function takes the metric tables it reads and returns one dataset. The
reference time is an argument (default: the current date), so a report can be
rebuilt for any day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import dates, text
from terrace.functions.columns import as_column
from terrace.operators.metrics import ratio_of_sums
from terrace.plans.energy import values as v

# Seasons, support, list length and labels shown in the reports.
WINDY_MONTHS, CALM_MONTHS = (7, 10), (1, 4)
LEAST_HOURS = 100
TOP_PLANTS = 10
VARIABLE_LABELS = {
    "vento_100m_ms": "vento a 100 m",
    "radiacao_solar_wm2": "radiação",
    "cobertura_nuvens_pct": "nuvens",
}
OTHER_VARIABLE_LABEL = "temperatura"
WEEKEND_LABEL, WEEKDAY_LABEL = "Fim de semana", "Dia útil"


def _percent(numerator: str | Column, denominator: str | Column) -> Column:
    """Weighted percentage to one place.

    The sum is scaled before the division: scaling a quotient would push exact
    halves such as 52.45 just below themselves and round them down.
    """
    return F.round(ratio_of_sums(F.lit(100) * as_column(numerator), denominator), 1)


def percent_by(df: DataFrame, groups: Sequence[str], numerator: str, denominator: str, output: str) -> DataFrame:
    """Weighted percentage per group."""
    return df.groupBy(*groups).agg(_percent(numerator, denominator).alias(output))


def _one_row(parts: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Headline numbers of several tables as one row: one pass per table.

    Each table is aggregated to a struct; the structs meet as scalar subqueries.
    """
    scalars: list[Column] = []
    for table, numbers in parts:
        packed = table.agg(F.struct(*[value.alias(name) for name, value in numbers.items()]).alias("_packed")).scalar()
        scalars += [packed[name].alias(name) for name in numbers]
    return parts[0][0].sparkSession.range(1).select(*scalars)


def headlines(
    monthly: DataFrame, shortfall: DataFrame, correlation: DataFrame, accuracy: DataFrame
) -> DataFrame:
    """Five headline numbers. Correlation and forecast error are plain means over groups, not weighted by hours."""

    def season(months: tuple[int, int]) -> Column:
        chosen = (F.col("tipo_usina") == v.WIND) & dates.in_season("mes", *months)
        return _percent(F.when(chosen, F.col("geracao_verificada_mwh")), F.when(chosen, F.col("capacidade_mwh")))

    wind = F.when(F.col("variavel") == v.CURVE_VARIABLE[v.WIND], F.col("correlacao"))
    return _one_row(
        [
            (
                monthly,
                {"fator_eolico_safra_pct": season(WINDY_MONTHS), "fator_eolico_entressafra_pct": season(CALM_MONTHS)},
            ),
            (shortfall, {"restricao_twh": F.round(F.sum("restricao_mwh") / 1e6, 1)}),
            (correlation, {"correlacao_vento": F.round(F.avg(wind), 2)}),
            (accuracy, {"erro_previsao_vento_kmh": F.round(F.avg("erro_medio_absoluto_vento_100m_kmh"), 1)}),
        ]
    )


def capacity_by_month(monthly: DataFrame) -> DataFrame:
    return percent_by(monthly, ["mes", "tipo_usina"], "geracao_verificada_mwh", "capacidade_mwh", "fator_pct")


def capacity_by_state(monthly: DataFrame) -> DataFrame:
    return percent_by(monthly, ["uf", "tipo_usina"], "geracao_verificada_mwh", "capacidade_mwh", "fator_pct")


def curve(power_curve: DataFrame, kind: str, axis: str) -> DataFrame:
    """Bins of one kind with enough hours behind them."""
    return power_curve.filter((F.col("tipo_usina") == kind) & (F.col("horas") >= LEAST_HOURS)).select(
        F.col("faixa_inicio").alias(axis),
        F.round(F.col("fator_capacidade") * 100, 1).alias("fator_pct"),
        "horas",
    )


def wind_curve(power_curve: DataFrame) -> DataFrame:
    return curve(power_curve, v.WIND, "vento_ms")


def solar_curve(power_curve: DataFrame) -> DataFrame:
    return curve(power_curve, v.SOLAR, "radiacao_wm2")


def main_correlations(correlation: DataFrame) -> DataFrame:
    label = text.recode("variavel", VARIABLE_LABELS, OTHER_VARIABLE_LABEL)
    return correlation.filter(F.col("variavel").isin(*v.CURVE_VARIABLE.values())).select(
        "uf",
        F.concat("tipo_usina", F.lit(": "), label).alias("relacao"),
        F.round("correlacao", 2).alias("correlacao"),
    )


def shortfall_by_month(shortfall: DataFrame, today: Column | None = None) -> DataFrame:
    """Complete months only."""
    day = F.current_date() if today is None else today
    return (
        shortfall.filter(dates.before_month_of("data", day))
        .groupBy(dates.month_start("data").alias("mes"))
        .agg(
            F.round(F.sum("restricao_mwh") / 1000, 0).alias("restricao_gwh"),
            _percent("restricao_mwh", "previsto_mwh").alias("restricao_pct"),
        )
    )


def most_limited_plants(plant_shortfall: DataFrame) -> DataFrame:
    """Top plants by shortfall; plants that tie on the rounded value follow by name."""
    return (
        plant_shortfall.groupBy("nome_usina")
        .agg(F.round(F.sum("restricao_mwh") / 1000, 1).alias("restricao_gwh"))
        .orderBy(F.desc("restricao_gwh"), "nome_usina")
        .limit(TOP_PLANTS)
    )


def schedule_error_by_month(schedule_error: DataFrame) -> DataFrame:
    return percent_by(schedule_error, ["mes", "tipo_usina"], "erro_absoluto_mwh", "geracao_verificada_mwh", "erro_pct")


def forecast_error_by_point(accuracy: DataFrame) -> DataFrame:
    """Plain means of the monthly values of each point."""
    return accuracy.groupBy("ponto_id").agg(
        F.round(F.avg("erro_medio_absoluto_vento_100m_kmh"), 1).alias("erro_vento_kmh"),
        F.round(F.avg("vento_100m_observado_kmh"), 1).alias("vento_medio_kmh"),
    )


def load_and_heat(load_temperature: DataFrame) -> DataFrame:
    return load_temperature.select(
        "temperatura_media_c",
        F.round(F.col("carga_mwmed") / 1000, 2).alias("carga_gwmed"),
        F.when(F.col("fim_de_semana"), WEEKEND_LABEL).otherwise(WEEKDAY_LABEL).alias("tipo_dia"),
    )


def build_all(tables: Mapping[str, DataFrame], today: Column | None = None) -> dict[str, DataFrame]:
    """Every business dataset by its name, from the metric tables by theirs."""
    return {
        "destaques": headlines(
            tables["aproveitamento_mensal"],
            tables["restricao_geracao_diaria"],
            tables["correlacao_clima_geracao"],
            tables["precisao_previsao_tempo"],
        ),
        "aproveitamento_ne": capacity_by_month(tables["aproveitamento_mensal"]),
        "aproveitamento_uf": capacity_by_state(tables["aproveitamento_mensal"]),
        "curva_eolica": wind_curve(tables["curva_de_potencia"]),
        "curva_solar": solar_curve(tables["curva_de_potencia"]),
        "correlacao": main_correlations(tables["correlacao_clima_geracao"]),
        "restricao_mensal": shortfall_by_month(tables["restricao_geracao_diaria"], today),
        "restricao_usinas": most_limited_plants(tables["restricao_geracao_por_usina"]),
        "precisao_programacao": schedule_error_by_month(tables["precisao_programacao_mensal"]),
        "precisao_tempo": forecast_error_by_point(tables["precisao_previsao_tempo"]),
        "carga_temperatura": load_and_heat(tables["carga_x_temperatura"]),
    }
