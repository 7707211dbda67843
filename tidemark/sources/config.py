"""Table, layer and column configuration as DataFrames, and single-row lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import surrogate_id
from tidemark.operators.quality import require_single
from tidemark.schemas import (
    ALLOWED_VALUES,
    LOAD_PRIORITIES,
    METADATA_SCHEMAS,
    SILVER_RULES,
    SOURCE_SYSTEM,
    ColumnRule,
)


def _in_layout(df: DataFrame, table: str, by: str, at: str) -> DataFrame:
    """Fills the audit columns and orders the rest as the metadata table has them."""
    stamp = F.lit(at).cast("timestamp")
    audit = {
        "created_at": stamp,
        "created_by": F.lit(by),
        "last_edited_at": stamp,
        "last_edited_by": F.lit(by),
    }
    fields = METADATA_SCHEMAS[table].fields
    return df.withColumns(audit).select(*[F.col(f.name).cast(f.dataType) for f in fields])


def table_config(
    spark: SparkSession,
    root: str,
    catalog: str = "spark_catalog",
    by: str = "setup",
    at: str = "1970-01-01",
    priorities: Mapping[str, int] = LOAD_PRIORITIES,
) -> DataFrame:
    """One row per business table: Parquet by date, evolving, Bronze target."""
    template = root.rstrip("/") + "/{}/dt={{run_dt}}/"
    rows = [
        (i, name, template.format(name), name.lower(), priority)
        for i, (name, priority) in enumerate(priorities.items(), start=1)
    ]
    schema = (
        "table_id bigint, source_table_name string, source_path_pattern string, "
        "target_table string, load_priority int"
    )
    df = spark.createDataFrame(rows, schema).withColumns(
        {
            "source_system": F.lit(SOURCE_SYSTEM),
            "source_format": F.lit("PARQUET"),
            "target_catalog": F.lit(catalog),
            "target_schema": F.lit("bronze"),
            "partition_cols": F.lit("dt"),
            "replace_where_template": F.lit("dt = '{run_dt}'"),
            "drift_policy": F.lit("EVOLVE"),
            "is_active": F.lit(True),
        }
    )
    return _in_layout(df, "table_config", by, at)


def process_config(
    tables: DataFrame,
    names: Sequence[str] = tuple(LOAD_PRIORITIES),
    process_type: str = "BRONZE",
    by: str = "setup",
    at: str = "1970-01-01",
) -> DataFrame:
    """An incremental as-is load for each named table."""
    df = tables.where(F.col("source_table_name").isin(*names)).select(
        surrogate_id("table_id", F.lit(process_type)).alias("process_config_id"),
        "table_id",
        F.lit(process_type).alias("process_type"),
        F.lit("INCREMENTAL").alias("load_type"),
        F.lit(None).cast("string").alias("depends_on_table_ids"),
        F.lit(None).cast("string").alias("transform_module"),
        F.lit(True).alias("is_active"),
    )
    return _in_layout(df, "table_process_config", by, at)


def rule_rows(
    spark: SparkSession, rules: Mapping[str, Sequence[ColumnRule]] = SILVER_RULES
) -> DataFrame:
    """The declared column rules as rows, keyed by table name."""
    schema = T.StructType(
        [
            T.StructField("source_table_name", T.StringType(), False),
            T.StructField("target_column_name", T.StringType(), False),
            T.StructField("source_column_name", T.StringType(), False),
            T.StructField("data_type", T.StringType(), False),
            T.StructField("is_nullable", T.BooleanType(), False),
            T.StructField("is_pii", T.BooleanType(), False),
            T.StructField("column_purpose", T.StringType(), False),
            T.StructField("is_active", T.BooleanType(), False),
        ]
    )
    rows = [
        (table, r.target, r.source, r.data_type, r.nullable, r.pii, r.purpose, r.active)
        for table, columns in rules.items()
        for r in columns
    ]
    return spark.createDataFrame(rows, schema)


def column_config(
    tables: DataFrame,
    rules: DataFrame,
    process_type: str = "SILVER",
    by: str = "setup",
    at: str = "1970-01-01",
) -> DataFrame:
    """Column rules with the table_id of the table they name.

    An equi join on the name; the declared rules are far below the broadcast limit.
    """
    df = (
        rules.join(tables.select("table_id", "source_table_name"), "source_table_name")
        .withColumn("process_type", F.lit(process_type))
        .withColumn(
            "column_id", surrogate_id("table_id", "process_type", "target_column_name")
        )
    )
    return _in_layout(df, "input_column_config", by, at)


def get_table_config(tables: DataFrame, table_name: str) -> dict:
    """The configuration of a table; an error unless there is exactly one."""
    return require_single(
        tables.where(F.col("source_table_name") == table_name), f"table_config of {table_name}"
    )


def get_process_config(
    tables: DataFrame, layers: DataFrame, table_name: str, process_type: str
) -> dict:
    """The rules of one layer of a table; an error unless there is exactly one row."""
    if process_type not in ALLOWED_VALUES["table_process_config"]["process_type"]:
        raise ValueError(f"unknown process_type {process_type!r}")
    named = tables.where(F.col("source_table_name") == table_name).select("table_id")
    matching = layers.where(F.col("process_type") == process_type).join(named, "table_id")
    return require_single(matching, f"{process_type} configuration of {table_name}")


def get_input_column_config(
    tables: DataFrame, columns: DataFrame, table_name: str, process_type: str = "SILVER"
) -> DataFrame:
    """The active column rules of a table from Silver on, as a DataFrame."""
    if process_type == "BRONZE":
        raise ValueError("Bronze loads as-is and has no column configuration")
    named = tables.where(F.col("source_table_name") == table_name).select("table_id")
    wanted = (F.col("process_type") == process_type) & F.col("is_active")
    return columns.where(wanted).join(named, "table_id")
