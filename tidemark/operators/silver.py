"""Silver tables built from column rules: rename, cast, derive, mask, check, de-duplicate.

The rules become one ``select``; nothing but the final de-duplication shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key, latest_where_rare
from tidemark.schemas import DERIVED_SUBSTRINGS, ColumnRule

REASONS = "reject_reasons"


def column_rules(config: DataFrame) -> list[ColumnRule]:
    """Config rows of one table and layer as rules.

    Collects as many rows as the table has columns.
    """
    rows = config.select(
        "source_column_name", "target_column_name", "data_type",
        "is_nullable", "is_pii", "column_purpose", "is_active",
    ).collect()
    return [
        ColumnRule(
            source=r.source_column_name,
            target=r.target_column_name or r.source_column_name,
            data_type=r.data_type,
            nullable=r.is_nullable is not False,
            pii=bool(r.is_pii),
            purpose=r.column_purpose or "ATTRIBUTE",
            active=bool(r.is_active),
        )
        for r in rows
    ]


def derived_value(rule: ColumnRule) -> Column:
    """The source value, or the piece of it that the target column is cut from."""
    value = F.col(rule.source)
    piece = DERIVED_SUBSTRINGS.get(rule.target)
    if piece and rule.purpose == "DERIVED" and rule.target != rule.source:
        return F.substring(value, *piece)
    return value


def masked(value: Column, data_type: str, salt: str) -> Column:
    """Text becomes a salted sha-256, dates keep their year, anything else is dropped."""
    kind = data_type.upper()
    if kind == "STRING":
        return F.sha2(F.concat(F.lit(salt), value), 256)
    if kind == "DATE":
        return F.trunc(value, "year")
    if kind == "TIMESTAMP":
        return F.date_trunc("year", value)
    return F.lit(None).cast(data_type)


_DAY_LIKE = {"date", "timestamp", "timestamp_ntz"}
_WIDENING = {("int", "bigint"), ("int", "double"), ("float", "double")}


def _cast_can_fail(source_type: str, target_type: str) -> bool:
    """Whether a cast may turn a value into NULL.

    Checks that cannot fail are left out of the plan, which otherwise would
    evaluate every source expression once more per row.
    """
    target_type = target_type.lower().replace(" ", "")
    if source_type == target_type or target_type == "string":
        return False
    if source_type in _DAY_LIKE and target_type in _DAY_LIKE:
        return False
    return (source_type, target_type) not in _WIDENING


def _projection(
    df: DataFrame, rules: Sequence[ColumnRule], salt: str
) -> tuple[list[Column], list[tuple[str, Column]]]:
    """Output columns, and what makes a row unfit: reason and condition."""
    kinds = dict(df.dtypes)
    outputs, faults = [], []
    for rule in (r for r in rules if r.active):
        raw = derived_value(rule)
        typed = raw.try_cast(rule.data_type)
        if _cast_can_fail(kinds[rule.source], rule.data_type):
            faults.append((f"cast:{rule.target}", raw.isNotNull() & typed.isNull()))
        if not rule.nullable:
            faults.append((f"null:{rule.target}", raw.isNull()))
        shown = masked(typed, rule.data_type, salt) if rule.pii else typed
        outputs.append(shown.alias(rule.target))
    return outputs, faults


def checked(df: DataFrame, rules: Sequence[ColumnRule], salt: str = "") -> DataFrame:
    """The configured columns plus ``reject_reasons``.

    A row is rejected for a required value that is missing (``null:<column>``) or
    any value that cannot be cast (``cast:<column>``).
    """
    outputs, faults = _projection(df, rules, salt)
    reasons = [F.when(fault, F.lit(reason)) for reason, fault in faults]
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.select(*outputs, listed.alias(REASONS))


def accepted(df: DataFrame, rules: Sequence[ColumnRule], salt: str = "") -> DataFrame:
    """The configured columns of the rows without a fault.

    A plain conjunction, so that null checks reach the scan.
    """
    outputs, faults = _projection(df, rules, salt)
    fit = df.where(reduce(and_, [~fault for _, fault in faults])) if faults else df
    return fit.select(*outputs)


def rejected(checked_df: DataFrame) -> DataFrame:
    return checked_df.where(F.size(REASONS) > 0)


def silver(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    key: Sequence[str],
    newest_first: Sequence[str] = ("LastUpdatedAt", "batch"),
    salt: str = "",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    rare_duplicates: bool = False,
) -> DataFrame:
    """Accepted rows, one per natural key, the newest kept.

    ``transform`` is the per-table hook that runs before the rules.  For a wide
    table with few repeated keys, ``rare_duplicates`` shuffles hashes of keys only.
    """
    source = df.transform(transform) if transform else df
    keep = latest_where_rare if rare_duplicates else latest_per_key
    return keep(accepted(source, rules, salt), key, newest_first)


_TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_transform(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Makes ``fn`` available under the name a config row gives in ``transform_module``."""
    _TRANSFORMS[name] = fn


def transform_for(name: str | None) -> Callable[[DataFrame], DataFrame] | None:
    if name is None:
        return None
    if name not in _TRANSFORMS:
        raise KeyError(f"no transform registered as {name!r}")
    return _TRANSFORMS[name]
