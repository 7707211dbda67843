"""UPDATE and DELETE as copy-on-write: the table after the edit, as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def updated(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """``changes`` where the condition is true; all right sides see the old values."""
    hit = F.coalesce(condition, F.lit(False))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.when(hit, changes[c].cast(kinds[c])).otherwise(F.col(c)).alias(c)
            if c in changes
            else F.col(c)
            for c in df.columns
        ]
    )


def without(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL keeps the row)."""
    return df.where(~F.coalesce(condition, F.lit(False)))
