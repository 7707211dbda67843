"""Row history from batches: validity intervals, differences, and joins as of a day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.joins import broadcast_if_small


def row_hash(columns: Sequence[str]) -> Column:
    """One digest over named values; a null differs from every value."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in columns]
    return F.sha2(F.concat_ws("\x01", *[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in values]), 256)


def validity(
    batches: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], snapshots: bool = False
) -> DataFrame:
    """``keys, values, valid_from, valid_to`` (exclusive, null while open) from rows by batch.

    Versions that change nothing are merged into the one before.  With ``snapshots`` every
    batch is the whole table: a key that a batch lacks ends there and begins anew when it is
    back.  A key that comes twice in a batch keeps its greatest row.  A key's window holds one row
    per batch at most, since equal places collapse before they are exchanged.
    """
    names = list(keys)
    rows = latest_per_key(batches.select(*names, at, *values), [*names, at], list(values))
    rows = rows.withColumn("_hash", row_hash(values))
    ordered = Window.partitionBy(*names).orderBy(at)
    if snapshots:
        # as many rows as there were batches
        known = batches.select(F.col(at).alias("_at")).distinct()
        following = known.withColumn("_next", F.lead("_at").over(Window.partitionBy(F.lit(0)).orderBy("_at")))
        rows = rows.join(broadcast_if_small(following), F.col(at) == F.col("_at")).drop("_at")
    else:
        rows = rows.withColumn("_next", F.lead(at).over(ordered))
    before, until = F.lag("_hash").over(ordered), F.lag("_next").over(ordered)
    starts = before.isNull() | (before != F.col("_hash")) | (until != F.col(at))
    numbered = rows.withColumn("_new", F.coalesce(starts, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("_version", F.sum("_new").over(ordered))
    picked = [F.first(f"`{c}`").alias(c) for c in values]
    return numbered.groupBy(*names, "_version").agg(
        *picked, F.min(at).alias("valid_from"), F.max_by("_next", at).alias("valid_to")
    ).drop("_version")


def difference(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys, change, changed``: INSERT, UPDATE or DELETE per key, and the columns that an update changed.

    Keys are unique on both sides.  One exchange by key; only hashes of the values travel.
    """
    names = list(keys)

    def side(df: DataFrame, mark: int) -> DataFrame:
        hashes = F.array(*[F.xxhash64(F.col(f"`{v}`").isNull(), F.col(f"`{v}`")) for v in values])
        return df.select(*names, F.lit(mark).alias("_side"), hashes.alias("_hashes"))

    both = side(before, 0).unionByName(side(after, 1)).groupBy(*names).agg(
        *[F.max(F.when(F.col("_side") == mark, F.col("_hashes"))).alias(name) for mark, name in ((0, "_old"), (1, "_new"))]
    )
    pairs = F.arrays_zip(F.array(*[F.lit(v) for v in values]).alias("name"), F.col("_old").alias("old"), F.col("_new").alias("new"))
    changed = F.transform(F.filter(pairs, lambda p: p["old"] != p["new"]), lambda p: p["name"])
    kind = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").when(F.size(changed) > 0, "UPDATE")
    empty = F.array().cast("array<string>")
    return both.select(
        *names, kind.alias("change"), F.when(kind == "UPDATE", changed).otherwise(empty).alias("changed")
    ).where(F.col("change").isNotNull())


def as_of_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str]
) -> DataFrame:
    """``facts`` with ``columns`` of the version that was valid on each fact's ``day``; null if none was.

    Versions are the disjoint intervals of ``validity``.  They are cut by month, so that
    the join is by key and month: a key with a long history and a third of the facts is as many join keys
    as months.  An open version reaches to the last day of the facts.
    """
    names = list(keys)
    last = facts.agg(F.max(day)).first()[0]
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
    months = F.sequence(F.trunc("valid_from", "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    cut = versions.where(F.col("valid_from") <= end).select(
        *[F.col(k).alias(f"_of_{k}") for k in names],
        *[F.col(c).alias(f"_as_{c}") for c in columns],
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.explode(months).alias("_month"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_of_{k}") for k in names])
    on = same & (F.trunc(day, "month") == F.col("_month")) & (F.col(day) >= F.col("_from"))
    on &= F.col("_to").isNull() | (F.col(day) < F.col("_to"))
    return facts.join(cut, on, "left").select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"_as_{c}").alias(c) for c in columns]
    )
