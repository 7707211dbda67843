"""The landing zone: ``<root>/<table>/dt=YYYY-MM-DD/batch=N/``."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import union_all

FORMATS = {"PARQUET": "parquet", "CSV": "csv", "JSON": "json", "DELTA": "delta"}
PATH_TEMPLATE = "{root}/{table}/dt={run_dt}/batch={batch}"

SCHEMA_NOTE = "_schema"  # readers of Parquet pass folders over that begin like this
NO_SOURCE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

RUN_ID, INGESTED_AT, SOURCE_FILE = "_ingestion_run_id", "_ingested_at", "_source_file"


def resolve_path(
    template: str, table: str = "", run_dt: str = "", batch: int | str = "", root: str = ""
) -> str:
    """Fills ``{root} {table} {run_dt} {batch}``, also under their names ``{dt}`` and
    ``{source_table}``."""
    return template.format(
        root=root, table=table, source_table=table, run_dt=run_dt, dt=run_dt, batch=batch
    )


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def landed(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """All batches of a table, with ``dt`` and ``batch`` from the folder names."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(root, table))


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a table, or None if there is no table at ``path``.

    Writers keep the schema next to the data, so that columns which came with a later
    partition are known without opening files.  A root without that note (a landing
    zone) is asked through the footers of all its files.
    """
    try:
        noted = spark.read.text(f"{path}/{SCHEMA_NOTE}", wholetext=True).first()
        if noted is not None:
            return T.StructType.fromJson(json.loads(noted["value"]))
    except AnalysisException as error:
        if error.getCondition() not in NO_SOURCE:
            raise
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in NO_SOURCE:
            return None
        raise


def read_partitioned(
    spark: SparkSession,
    path: str,
    dt: str | Iterable[str] | None = None,
    batch: int | Iterable[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A partitioned Parquet root, optionally narrowed to dates and batches.

    Both filters are on partition columns: folders outside are never opened.  Without a
    ``schema`` all columns of the table are read, also those that only some partitions have.
    """
    schema = schema or table_schema(spark, path)
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if dt is not None:
        days = [dt] if isinstance(dt, str) else list(dt)
        df = df.where(F.col("dt").isin(*[F.lit(d).cast("date") for d in days]))
    if batch is not None:
        numbers = [batch] if isinstance(batch, int) else list(batch)
        df = df.where(F.col("batch").isin(*numbers))
    return df


def read_batch(
    spark: SparkSession, root: str, table: str, run_dt: str, batch: int
) -> DataFrame:
    """One batch folder with its own schema, as drift checks need it."""
    folder = resolve_path(PATH_TEMPLATE, table, run_dt, batch, root.rstrip("/"))
    return spark.read.parquet(folder)


def read_source(
    spark: SparkSession,
    source_format: str,
    path: str,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Reads by the configured format name.  DELTA needs its package on the cluster."""
    try:
        name = FORMATS[source_format.upper()]
    except KeyError:
        raise ValueError(f"unknown source_format {source_format!r}") from None
    reader = spark.read.format(name).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def rows_since(df: DataFrame, column: str, since: str | date | None) -> DataFrame:
    """Rows strictly after the watermark; all rows if there is none yet.

    The bound is a literal, so it reaches the scan as a partition or Parquet filter.
    """
    if since is None:
        return df
    kind = df.schema[column].dataType
    return df.where(F.col(column) > F.lit(str(since)).cast(kind))


def high_water_mark(log: DataFrame, table_id: int) -> date | None:
    """The last successful business date of one table: one value, fetched."""
    row = (
        log.where((F.col("table_id") == table_id) & (F.col("status") == "SUCCESS"))
        .agg(F.max("run_dt").alias("watermark"))
        .first()
    )
    return row["watermark"]


def stamp_lineage(df: DataFrame, run_id: str, ingested_at: Column | None = None) -> DataFrame:
    """Adds run id, load time and source file.  Apply it directly on a file scan."""
    return df.select(
        "*",
        F.lit(run_id).alias(RUN_ID),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias(INGESTED_AT),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )


def inventory(spark: SparkSession, root: str, tables: Iterable[str]) -> DataFrame:
    """``table_name, dt, batch, path, length`` for every landed file.

    A file listing: one row per file, no data page is read.
    """
    parts = []
    for table in tables:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .load(table_path(root, table))
        )
        parts.append(files.select(F.lit(table).alias("table_name"), "dt", "batch", "path", "length"))
    return union_all(parts)


def inventory_summary(files: DataFrame, *by: str) -> DataFrame:
    """Dates, batches, files and bytes per group."""
    return files.groupBy(*by).agg(
        F.countDistinct("dt").alias("dates"),
        F.countDistinct("dt", "batch").alias("batches"),
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
    )


def next_batches(batches: DataFrame) -> DataFrame:
    """``dt, next_batch`` from ``dt, batch`` pairs."""
    return batches.groupBy("dt").agg((F.max("batch") + 1).alias("next_batch"))


def next_batch(spark: SparkSession, root: str, dt: str, anchor: str = "t_Client") -> int:
    """The batch number all tables use for the next delivery of a date.

    The anchor table decides; 1 if it has nothing for that date.  Only that
    date's folder is listed.
    """
    base = table_path(root, anchor)
    try:
        files = (
            spark.read.format("binaryFile")
            .option("basePath", base)
            .option("pathGlobFilter", "*.parquet")
            .load(f"{base}/dt={dt}")
        )
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 1
        raise
    row = files.agg(F.max("batch").alias("batch")).first()
    return (row["batch"] or 0) + 1


def has_rows(df: DataFrame) -> bool:
    """Whether a (pruned) scan delivers anything; stops at the first row."""
    return not df.isEmpty()
