"""Known defects put into clean input, so that the checks have something to find.

Which rows are hit is decided by a hash of their key: the counts are exact and
repeatable on any cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import in_hash_sample

# --- fixed values: share of rows hit ---------------------------------------
NULL_RATE = 0.01
DUPLICATE_RATE = 0.005
TRUNCATE_RATE = 0.001
FUTURE_RATE = 0.0005
FUTURE_DAYS = 30
# --------------------------------------------------------------------------


def blank(df: DataFrame, column: str, key: Sequence[str], rate: float = NULL_RATE) -> DataFrame:
    """NULL in ``column`` of the sampled keys."""
    hit = in_hash_sample(rate, *key, salt="blank")
    return df.withColumn(column, F.when(~hit, F.col(column)))


def duplicate(df: DataFrame, key: Sequence[str], rate: float = DUPLICATE_RATE) -> DataFrame:
    """The sampled rows once more.  Written as an explode, to scan the input once."""
    copies = F.when(in_hash_sample(rate, *key, salt="duplicate"), 2).otherwise(1)
    return (
        df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("_copy")
    )


def truncate(
    df: DataFrame, column: str, key: Sequence[str], rate: float = TRUNCATE_RATE
) -> DataFrame:
    """The last character cut off ``column`` of the sampled keys."""
    text = F.col(column)
    hit = in_hash_sample(rate, *key, salt="truncate")
    shorter = text.substr(F.lit(1), F.greatest(F.length(text) - 1, F.lit(0)))
    return df.withColumn(column, F.when(hit, shorter).otherwise(text))


def postdate(
    df: DataFrame,
    column: str,
    key: Sequence[str],
    rate: float = FUTURE_RATE,
    days: int = FUTURE_DAYS,
) -> DataFrame:
    """``column`` of the sampled keys moved ``days`` ahead."""
    hit = in_hash_sample(rate, *key, salt="postdate")
    moved = F.col(column) + F.expr(f"INTERVAL {int(days)} DAYS")
    return df.withColumn(column, F.when(hit, moved).otherwise(F.col(column)))
