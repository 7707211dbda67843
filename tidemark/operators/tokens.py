"""Tokens in place of personal values: the same for a value everywhere, and reversible for who may read the vault.

A token is a keyed hash, so replacing values is a projection; the vault is what makes it
reversible, and what proves that no two values share a token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.quality import assert_all
from tidemark.session import staged
from tidemark.sinks.tables import append, table_schema
from tidemark.sources.landing import read_partitioned

PREFIX = "TOK"
DIGITS = 24


def token(value: Column, salt: str, digits: int = DIGITS) -> Column:
    """The token of a value; null stays null.  The salt is the secret."""
    digest = F.sha2(F.concat(F.lit(salt), F.lit("|"), value.cast("string")), 256)
    return F.concat(F.lit(PREFIX), F.upper(F.substring(digest, 1, digits)))


def tokenised(df: DataFrame, columns: Sequence[str], salt: str, digits: int = DIGITS) -> DataFrame:
    """``df`` with the named columns replaced by tokens; no shuffle."""
    return df.withColumns({c: token(F.col(f"`{c}`"), salt, digits) for c in columns})


def register(
    spark: SparkSession, path: str, values: DataFrame, salt: str, digits: int = DIGITS
) -> int:
    """Grows the vault at ``path`` by the values (first column) that it lacks; returns how many.

    A value is known once, however often it occurs in however many loads: values are made
    distinct map-side and anti-joined with the vault.  If two values would share a
    token, nothing is written and the load fails.
    """
    value = F.col(f"`{values.columns[0]}`").cast("string").alias("value")
    fresh = values.select(value).where(F.col("value").isNotNull()).distinct()
    vault = vault_at(spark, path)
    if vault is not None:
        fresh = fresh.join(vault.select("value"), "value", "left_anti")
    fresh = staged(fresh.select("value", token(F.col("value"), salt, digits).alias("token")), "new-tokens")
    issued = fresh if vault is None else fresh.unionByName(vault)
    shared = issued.groupBy("token").agg(F.count(F.lit(1)).alias("values")).where("values > 1")
    if not shared.isEmpty():
        raise ValueError("two values share a token; use more digits")
    found = fresh.count()
    if found:
        append(fresh, path)
    return found


def vault_at(spark: SparkSession, path: str) -> DataFrame | None:
    """``value, token`` as issued so far; None before the first load."""
    return None if table_schema(spark, path) is None else read_partitioned(spark, path).select("value", "token")


def restored(df: DataFrame, columns: Sequence[str], vault: DataFrame) -> DataFrame:
    """``df`` with tokens turned back into values; a token the vault lacks is an error.

    A vault that measures small is broadcast; else one join per column, whose hot tokens AQE splits.
    """
    known = broadcast_if_small(vault)
    for c in columns:
        pairs = known.select(F.col("token").alias("_token"), F.col("value").alias("_value"))
        joined = df.join(pairs, F.col(f"`{c}`") == F.col("_token"), "left")
        joined = assert_all(joined, F.col(f"`{c}`").isNull() | F.col("_token").isNotNull(), f"unknown token in {c}")
        df = joined.withColumn(c, F.col("_value")).drop("_token", "_value")
    return df
