"""Running totals and gap-free numbers over one key of any size.

A window without a partition, or over one hot key, gathers every row in one task.  Here
rows are laid out by range, each range is added up on its own, and the totals of the
ranges before it are added back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged

_PART, _ROW, _BEFORE = "_range", "_row", "_before"


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: dict[str, Column],
    by: Sequence[str] = (),
    ties: bool = True,
) -> DataFrame:
    """``df`` with, per entry of ``totals``, the sum up to and including the row.

    Rows are ordered by ``order`` within ``by`` (one sequence if left out); nulls come
    first and a null amount counts as 0.  With ``ties`` rows that agree on ``by`` and
    ``order`` are told apart by the place they were written at, so that even equal rows
    spread over ranges; that costs one more write and is not needed where ``by`` and
    ``order`` are unique.

    A range holds about one share of all rows, whatever the keys.  The ranges' totals are
    at most one row per range and key in it, joined by both.
    """
    keys, sequence = list(by), list(order)
    if ties:
        df = staged(df.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
        sequence.append(_ROW)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = df.repartitionByRange(parts, *keys, *sequence)
    laid_out = staged(laid_out.withColumn(_PART, F.spark_partition_id()), "ranges")

    amounts = {name: F.coalesce(value, F.lit(0)) for name, value in totals.items()}
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy(*keys, _PART)
        .agg(*[F.sum(value).alias(name) for name, value in amounts.items()])
        .select(
            *[F.col(k).alias(f"_of_{k}") for k in keys],
            F.col(_PART).alias(f"_of{_PART}"),
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{_BEFORE}_{n}") for n in amounts],
        )
    )
    offsets = broadcast_if_small(staged(offsets, "range-totals"))
    within = Window.partitionBy(*keys, _PART).orderBy(*sequence).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # named apart from the columns of df, which may be what the amounts are made of
    summed = laid_out.withColumns({f"_sum_{n}": F.sum(v).over(within) for n, v in amounts.items()})
    same = F.col(_PART) == F.col(f"_of{_PART}")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    kept = [c for c in df.columns if c != _ROW and c not in totals]
    return summed.join(offsets, same).select(
        *[F.col(f"`{c}`") for c in kept],
        *[(F.col(f"_sum_{n}") + F.col(f"{_BEFORE}_{n}")).alias(n) for n in totals],
    )


def dense_numbers(
    df: DataFrame, order: Sequence[str], name: str, first: int = 1, ties: bool = True
) -> DataFrame:
    """``df`` with the gap-free number of each row in the given order."""
    numbered = running_totals(df, order, {name: F.lit(1).cast("bigint")}, ties=ties)
    return numbered.withColumn(name, F.col(name) + (first - 1))
