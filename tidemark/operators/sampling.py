"""Samples of an exact size per stratum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged

_PREFIX = 4  # hex digits by which a stratum is cut: 65,536 pieces


def sample_order(keys: Sequence[str], salt: str) -> Column:
    """A salted digest of the key; the rows with the smallest ones are the sample."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("<null>")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(salt), *parts))


def fixed_sample(
    df: DataFrame, keys: Sequence[str], strata: Sequence[str], salt: str, share: float | None = None, size: int | None = None
) -> DataFrame:
    """Exactly ``size`` rows of each stratum, or ``share`` of them rounded half up; all if there are fewer.

    ``keys`` identify a row; rows that share a key are taken in any order.  Which rows are
    taken depends on their keys and the salt alone.  The digests are counted by their first
    digits, map-side; whole pieces below the one where the sample ends are taken as they
    are, and only the rows of that piece are ranked, so that a stratum with a third of
    all rows is never sorted in one task.
    """
    if (share is None) == (size is None):
        raise ValueError("name either a share or a size")
    names = list(strata)
    marked = df.withColumn("_order", sample_order(keys, salt)).withColumn("_piece", F.substring("_order", 1, _PREFIX))
    counts = marked.groupBy(*names, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    ordered = Window.partitionBy(*names).orderBy("_piece")
    whole = Window.partitionBy(*names)
    wanted = F.lit(size) if share is None else F.floor(F.sum("_rows").over(whole) * F.lit(share) + F.lit(0.5))
    below = F.coalesce(F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = staged(
        counts.withColumn("_left", wanted - below).where("_left > 0").select(
            *[F.col(s).alias(f"_of_{s}") for s in names],
            F.col("_piece").alias("_of_piece"),
            F.when(F.col("_rows") > F.col("_left"), F.col("_left")).alias("_last"),
        ),
        "sample-pieces",
    )
    same = F.col("_piece") == F.col("_of_piece")
    for s in names:
        same &= F.col(s).eqNullSafe(F.col(f"_of_{s}"))
    kept = marked.join(broadcast_if_small(pieces), same)
    columns = [F.col(f"`{c}`") for c in df.columns]
    taken = kept.where("_last IS NULL").select(*columns)
    last = kept.where("_last IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy(*names, "_piece").orderBy("_order", *keys))
    return taken.unionByName(last.withColumn("_rank", rank).where("_rank <= _last").select(*columns))
