"""Data-quality checks: each is one scan with counts combined map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import union_all


def null_rates(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """``table_name, column_name, rows, nulls``, one row per column, one scan for all."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("nulls"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), "rows", F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def key_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Summary of a primary-key check: rows, distinct keys, duplicated keys, NULL keys."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("copies") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("copies"))), F.lit(0)).alias("null_key_rows"),
    )


def malformed(df: DataFrame, column: str, expected_length: int) -> DataFrame:
    """Rows whose key does not have the agreed length."""
    return df.where(F.length(column) != expected_length)


def later_than(df: DataFrame, column: str, reference: str) -> DataFrame:
    """Rows whose audit time lies after the event it describes."""
    return df.where(F.col(column) > F.col(reference))


def not_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the list.  NULL is left to the NOT NULL check."""
    return df.where(~F.col(column).isin(*allowed))


def value_violations(df: DataFrame, table: str, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """``table_name, column_name, rows, violations`` for allowed-value rules, in one scan."""
    columns = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(~F.col(c).isin(*rules[c])).alias(f"v_{i}")
            for i, c in enumerate(columns)
        ],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"v_{i}").alias("violations"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), "rows", F.inline(pairs))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, records`` for every table."""
    return union_all(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("records"))
            for name, df in tables.items()
        ]
    )


def require_single(df: DataFrame, what: str) -> dict:
    """The only row of ``df`` as a dict; an error if there is none or more than one.

    Fetches at most two rows.
    """
    rows = df.limit(2).collect()
    if len(rows) != 1:
        found = "no row" if not rows else "several rows"
        raise ValueError(f"{what}: expected exactly one row, found {found}")
    return rows[0].asDict()


def lookup_verdicts(df: DataFrame, key: str) -> DataFrame:
    """The set-wide form of ``require_single``: rows per key and OK or AMBIGUOUS."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("matches"))
        .withColumn("verdict", F.when(F.col("matches") == 1, "OK").otherwise("AMBIGUOUS"))
    )


def assert_all(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """``df``, failing the job on the first row that does not meet ``condition``.

    Checked while the rows pass by; no extra scan.
    """
    holds = F.coalesce(condition, F.lit(False))
    return df.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
