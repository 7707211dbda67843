"""Volume reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import union_all


def rows_per_date(df: DataFrame, table: str, day: Column | str = "dt") -> DataFrame:
    """``table_name, dt, records``.  Reads the date column only."""
    return df.groupBy((F.col(day) if isinstance(day, str) else day).alias("dt")).agg(
        F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("records")
    )


def volume_report(tables: Mapping[str, tuple[DataFrame, Column | str]]) -> DataFrame:
    """``rows_per_date`` of all tables, sorted by table and date."""
    parts = [rows_per_date(df, name, day) for name, (df, day) in tables.items()]
    return union_all(parts).select("table_name", "dt", "records").orderBy("table_name", "dt")
