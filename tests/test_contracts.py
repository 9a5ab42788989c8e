"""Declarations, contracts, dictionary, and the whole chain on empty and small inputs."""

import dataclasses

import pytest

from terrace.plans import spec
from terrace.plans.energy.catalog import ALL_TABLES, CLEAN_TABLES, METRIC_TABLES
from terrace.plans.energy.reports import build_all
from terrace.plans.runner import compute_metrics, refresh_metrics


@pytest.fixture
def empty_clean(spark):
    by_name = {t.name: t for t in CLEAN_TABLES}
    return lambda name: spark.createDataFrame([], spec.struct_of(by_name[name].stored))


def test_names_are_unique():
    names = [name for table in ALL_TABLES for name in table.objects()]
    assert len(names) == len(set(names))


def test_metric_tables_keep_their_contract_on_clean_schemas(spark, empty_clean):
    made = compute_metrics(METRIC_TABLES, empty_clean)  # raises when a schema differs
    assert set(made) == {t.name for t in METRIC_TABLES}
    assert all(df.count() == 0 for df in made.values())


def test_every_metric_input_is_declared():
    clean, metric = {t.name for t in CLEAN_TABLES}, {t.name for t in METRIC_TABLES}
    for table in METRIC_TABLES:
        assert set(table.clean_inputs) <= clean and set(table.metric_inputs) <= metric


def test_dependency_order_and_cycles():
    backwards = spec.in_dependency_order(METRIC_TABLES[::-1])
    names = [t.name for t in backwards]
    assert names.index("clima_x_geracao_horaria") < names.index("curva_de_potencia")
    a = spec.MetricTable("a", "", "", lambda x: x, (), metric_inputs=("b",))
    b = dataclasses.replace(a, name="b", metric_inputs=("a",))
    with pytest.raises(spec.ContractError, match="a -> b -> a"):
        spec.in_dependency_order([a, b])


@pytest.mark.parametrize(
    "change, problem",
    [
        ({"key": ("nope",)}, "key outside"),
        ({"versioned": ("data",)}, "key column is versioned"),
        ({"versioned": ("nope",)}, "versioned column outside"),
        ({"month_column": "carga_mwmed"}, "partition outside the key"),
        ({"warn_rules": {"chave_presente": "true"}}, "rule name used twice"),
    ],
)
def test_inconsistent_declarations_are_refused(spark, change, problem):
    with pytest.raises(spec.ContractError, match=problem):
        spec.check_definition(dataclasses.replace(CLEAN_TABLES[0], **change), spark)


def test_rules_must_be_conditions_over_the_columns(spark):
    with pytest.raises(spec.ContractError, match="not a condition"):
        spec.check_definition(dataclasses.replace(CLEAN_TABLES[0], warn_rules={"r": "carga_mwmed"}), spark)
    with pytest.raises(Exception, match="UNRESOLVED"):
        spec.check_definition(dataclasses.replace(CLEAN_TABLES[0], warn_rules={"r": "nope > 0"}), spark)


def test_dictionary_covers_every_column(spark):
    rows = spec.dictionary(spark, ALL_TABLES)
    assert spec.undocumented(rows).count() == 0
    assert rows.filter("table = 'carga_energia_versoes'").count() == 4 + 5
    assert rows.select("layer").distinct().count() == 2


def test_comments_travel_with_the_schema(spark):
    field = spec.struct_of(CLEAN_TABLES[0].columns)["carga_mwmed"]
    assert field.metadata["comment"]


def test_refresh_publishes_every_metric_table_and_reports_read_them(spark, empty_clean, tmp_path):
    made = refresh_metrics(METRIC_TABLES, empty_clean, str(tmp_path))
    datasets = build_all(made)
    assert len(datasets) == 11
    assert datasets["destaques"].count() == 1
    assert all(df.count() == 0 for name, df in datasets.items() if name != "destaques")
