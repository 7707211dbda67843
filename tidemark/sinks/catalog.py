"""Databases and the metadata tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import METADATA_SCHEMAS
from tidemark.session import work_path

LAYERS = ["metadata", "raw", "bronze", "silver", "gold"]


def create_layers(spark: SparkSession, prefix: str = "") -> list[str]:
    """One database per layer."""
    names = [f"{prefix}{layer}" for layer in LAYERS]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return names


def create_metadata_tables(spark: SparkSession, database: str = "metadata") -> list[str]:
    """The six metadata tables with column notes, parents first."""
    names = []
    for name, schema in METADATA_SCHEMAS.items():
        full = f"{database}.{name}"
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, source="parquet", schema=schema)
        names.append(full)
    return names


def drop_metadata_tables(spark: SparkSession, database: str = "metadata") -> None:
    """Drops them, children first."""
    for name in reversed(list(METADATA_SCHEMAS)):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def insert_rows(df: DataFrame, table: str) -> None:
    """Appends rows by column name; columns the frame lacks become NULL."""
    target = df.sparkSession.table(table)
    here = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in here else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    df.select(*columns).write.mode("append").saveAsTable(table)


def replace_rows(df: DataFrame, table: str) -> None:
    """The table becomes ``df``, which may be computed from the table itself."""
    spark = df.sparkSession
    staging = work_path(spark, "replace")
    df.write.parquet(staging)
    staged = spark.read.schema(df.schema).parquet(staging)
    staged.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def drop_partitions(
    spark: SparkSession, tables: Iterable[str], dt: str
) -> dict[str, str | None]:
    """Drops one date from several tables; a failure is noted and the rest go on.

    Returns the error text, or None, per table.
    """
    outcome: dict[str, str | None] = {}
    for table in tables:
        try:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt = DATE '{dt}')")
            outcome[table] = None
        except Exception as error:  # noqa: BLE001 - reported to the caller per table
            outcome[table] = str(error)
    return outcome


def describe(spark: SparkSession, database: str) -> DataFrame:
    """``table_name, position, column_name, data_type, nullable`` of a database's tables."""
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType(), False),
            T.StructField("position", T.IntegerType(), False),
            T.StructField("column_name", T.StringType(), False),
            T.StructField("data_type", T.StringType(), False),
            T.StructField("nullable", T.BooleanType(), False),
        ]
    )
    rows = [
        (t.name, i, f.name, f.dataType.simpleString(), f.nullable)
        for t in spark.catalog.listTables(database)
        for i, f in enumerate(spark.table(f"{database}.{t.name}").schema.fields)
    ]
    return spark.createDataFrame(rows, schema)


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL with named parameters (``:name``), NULL and typed values included."""
    return spark.sql(sql, args=args)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
