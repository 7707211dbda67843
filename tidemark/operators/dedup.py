"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]
) -> DataFrame:
    """The newest row of each key.

    ``row_number() = 1`` is planned as a WindowGroupLimit before and after the
    exchange: every map task sends at most one row per key, so neither a hot key
    nor a thousand copies of one row travel.  A hash of the other columns is the last
    tie-breaker: one number is sorted, and equal input gives an equal result on any layout.
    """
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest_first]
    named = {c for c in newest_first if isinstance(c, str)} | set(keys)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in named]
    order += [F.xxhash64(*rest).desc()] if rest else []
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


_KEY_HASH = "_key_hash"


def latest_where_rare(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]
) -> DataFrame:
    """``latest_per_key`` for input in which few keys occur twice.

    Hashes of keys that occur twice are found first and staged: of a row only one number is
    shuffled, counted map-side, however wide its key.  If they measure small they are
    broadcast; all other rows pass without a shuffle or a sort, and only the rows with such a
    hash are ranked, by the keys themselves, so that keys that happen to share a hash are
    told apart.  If not, every row is ranked.  Reads the input twice, so it pays off where
    whole rows are many times wider than a number.
    """
    marked = df.withColumn(_KEY_HASH, F.xxhash64(*keys))
    repeated = staged(
        marked.groupBy(_KEY_HASH).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(_KEY_HASH),
        "repeated-keys",
    )
    checked = broadcast_if_small(repeated)
    if checked is repeated:
        return latest_per_key(df, keys, newest_first)
    single = marked.join(checked, _KEY_HASH, "left_anti").drop(_KEY_HASH)
    copies = marked.join(checked, _KEY_HASH, "left_semi").drop(_KEY_HASH)
    return single.unionByName(latest_per_key(copies, keys, newest_first))


def as_of_batch(
    df: DataFrame, keys: Sequence[str], batch: int, batch_column: str = "batch",
    newest_first: Sequence[str | Column] = (),
) -> DataFrame:
    """The table as it stood after ``batch``: newest row per key among batches up to it."""
    seen = df.where(F.col(batch_column) <= batch)
    return latest_per_key(seen, keys, [batch_column, *newest_first])


def upsert(existing: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``changes`` put in by key.

    One exchange instead of an anti join and a union, and hot keys are cut
    down map-side.  Both sides need the same columns; the key must be unique
    within each of them for the result to be well defined.
    """
    tagged = existing.withColumn("_newer", F.lit(0)).unionByName(
        changes.withColumn("_newer", F.lit(1))
    )
    return latest_per_key(tagged, keys, ["_newer"]).drop("_newer")
