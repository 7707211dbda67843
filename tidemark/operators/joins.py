"""Joins: orphan detection, declared relations, size-checked broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import Relation
from tidemark.session import staged

BROADCAST_LIMIT_MB = 10
_BROADCAST_ROWS = 200_000
_HOT_KEYS = 1_000


def broadcast_if_small(
    df: DataFrame, threshold_mb: float = BROADCAST_LIMIT_MB, max_rows: int = _BROADCAST_ROWS
) -> DataFrame:
    """``broadcast(df)`` if its measured size is within the limit, else ``df``.

    Runs one bounded job that looks at ``max_rows + 1`` rows at most.  Hand in a
    staged frame if computing it is expensive, since the check computes it too.
    """
    probe = (
        df.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
        )
        .first()
    )
    fits = probe["rows"] <= max_rows and probe["bytes"] <= threshold_mb * 1024 * 1024
    return F.broadcast(df) if fits else df


def orphan_rows(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """Child rows without a parent.  A NULL key has no parent.

    The missing keys are found first, from keys counted map-side, and staged; the
    rows are then fetched by a second scan.  When the missing keys are few, which
    is measured, they are broadcast and no child row is ever shuffled.  Otherwise
    the thousand keys with the most orphans are broadcast and the rest is joined
    by key, where no single key can hold more than a thousandth of the orphans.
    """
    names = list(keys)
    missing = staged(orphan_counts(child, parent, keys, parent_keys), "missing-keys")
    checked = broadcast_if_small(missing)
    if checked is not missing:
        return matching(child, checked, names)
    heaviest = missing.orderBy(F.desc("orphans"), *names).limit(_HOT_KEYS)
    others = matching(missing, F.broadcast(heaviest), names, "left_anti")
    return matching(child, F.broadcast(heaviest), names).unionByName(
        matching(child, others, names)
    )


def matching(
    df: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi"
) -> DataFrame:
    """Rows whose key is in ``wanted`` (or is not, for an anti join); NULL equals NULL."""
    other = wanted.select([F.col(k).alias(f"_wanted_{k}") for k in keys])
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_wanted_{k}")) for k in keys]
    )
    return df.join(other, same, how)


def orphan_counts(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """``keys..., orphans``: number of parentless child rows per missing key.

    The child is counted per key before it is shuffled, so a key holding a
    third of all rows arrives as one row per map task.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("orphans"))
    return counted.join(_keys_as(parent, keys, parent_keys), list(keys), "left_anti")


def _keys_as(
    parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None
) -> DataFrame:
    """The parent's distinct keys under the child's names.

    Distinct first: a parent key with many copies collapses map-side, and the
    aggregate's exchange serves the join as well.
    """
    names = list(parent_keys or keys)
    return parent.select(
        [F.col(p).alias(k) for p, k in zip(names, keys, strict=True)]
    ).distinct()


def relation_checks(
    tables: Mapping[str, DataFrame], relations: Sequence[Relation], skip_null_keys: bool = True
) -> DataFrame:
    """One row per declared relation: rows checked, orphan rows, orphan keys.

    A child row whose key is NULL is exempt, as in a SQL foreign key.
    """
    parts = []
    for relation in relations:
        keys = list(relation.child_keys)
        child = tables[relation.child].select(*keys)
        if skip_null_keys:
            child = child.dropna(subset=keys)
        counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        known = (
            _keys_as(tables[relation.parent], keys, relation.parent_keys)
            .withColumn("known", F.lit(True))
        )
        missing = F.col("known").isNull()
        parts.append(
            counted.join(known, keys, "left").agg(
                F.lit(relation.child).alias("child_table"),
                F.lit(",".join(relation.child_keys)).alias("child_column"),
                F.lit(relation.parent).alias("parent_table"),
                F.lit(",".join(relation.parent_keys)).alias("parent_column"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("checked_rows"),
                F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
                F.count_if(missing).alias("orphan_keys"),
            )
        )
    return union_all(parts)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """The frames under one another, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
