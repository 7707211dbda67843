import pytest

from tidemark.operators import quality, silver
from tidemark.schemas import ALLOWED_VALUES, METADATA_SCHEMAS, SILVER_RULES
from tidemark.sources import config


@pytest.fixture(scope="module")
def tables(spark):
    return config.table_config(spark, "/landing").cache()


@pytest.fixture(scope="module")
def columns(spark, tables):
    return config.column_config(tables, config.rule_rows(spark)).cache()


def test_seeded_configuration(tables, columns):
    layers = config.process_config(tables)
    assert (tables.count(), layers.count(), columns.count()) == (5, 5, 89)
    for name, df in (("table_config", tables), ("table_process_config", layers),
                     ("input_column_config", columns)):
        assert df.columns == METADATA_SCHEMAS[name].fieldNames()
        for column, allowed in ALLOWED_VALUES[name].items():
            assert quality.not_allowed(df, column, allowed).count() == 0


def test_lookups(tables):
    layers = config.process_config(tables)
    found = config.get_table_config(tables, "t_Loan")
    assert found["load_priority"] == 30
    assert found["source_path_pattern"] == "/landing/t_Loan/dt={run_dt}/"
    assert config.get_process_config(tables, layers, "t_Loan", "BRONZE")["load_type"] == "INCREMENTAL"
    with pytest.raises(ValueError, match="no row"):
        config.get_table_config(tables, "t_None")
    with pytest.raises(ValueError, match="several rows"):
        config.get_table_config(tables.unionByName(tables), "t_Loan")
    with pytest.raises(ValueError, match="unknown process_type"):
        config.get_process_config(tables, layers, "t_Loan", "bronze")
    with pytest.raises(ValueError, match="no row"):
        config.get_process_config(tables, layers, "t_Loan", "GOLD")


def test_column_rules_survive_the_table(tables, columns):
    for name, rules in SILVER_RULES.items():
        stored = config.get_input_column_config(tables, columns, name)
        assert sorted(silver.column_rules(stored), key=repr) == sorted(rules, key=repr)
    with pytest.raises(ValueError):
        config.get_input_column_config(tables, columns, "t_Loan", "BRONZE")
