"""Registered queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text, so that two engines compare alike."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, kinds)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register
