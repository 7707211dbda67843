"""Stable keys, code pickers and hash sampling: pure expressions, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands in for NULL inside a key, since concat_ws would skip the part and let
# ('a', NULL, 'b') collide with ('a', 'b').
_NULL_PART = "<null>"


def _text_parts(parts: Sequence[Column | str]) -> list[Column]:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return [F.coalesce(c.cast("string"), F.lit(_NULL_PART)) for c in columns]


def hash_key(
    *parts: Column | str, prefix: str = "", digits: int = 32, separator: str = "|"
) -> Column:
    """Upper-case md5 over the parts, cut to ``digits`` and prefixed.

    The same key on any cluster and any layout, which a row number is not.
    """
    digest = F.upper(F.md5(F.concat_ws(separator, *_text_parts(parts))))
    if digits < 32:
        digest = F.substring(digest, 1, digits)
    return F.concat(F.lit(prefix), digest) if prefix else digest


def surrogate_id(*parts: Column | str) -> Column:
    """A 64-bit surrogate for a natural key, where tables have no identity column."""
    return F.xxhash64(*_text_parts(parts))


def in_hash_sample(rate: float, *parts: Column | str, salt: str) -> Column:
    """True for about ``rate`` of all keys, always for the same ones.

    The leading hex digits of a salted md5 are compared as text.  Unlike
    ``rand(seed)`` the outcome does not depend on the partitioning, so retries
    and re-plans keep the same rows; and Catalyst may push it through projects.
    """
    if rate >= 1:
        return F.lit(True)
    cut = hash_cut(rate)
    digest = F.md5(F.concat_ws("|", F.lit(salt), *_text_parts(parts)))
    return F.substring(digest, 1, len(cut)) < F.lit(cut)


def hash_cut(rate: float) -> str:
    """The eight hex digits below which a digest belongs to the sample."""
    return format(int(rate * 16**8), "08x")


def pick(values: Sequence[str], number: Column) -> Column:
    """``values[number % len(values)]``: one constant array, not a CASE per value."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (number % len(values) + 1).cast("int"))


def padded(number: Column, width: int) -> Column:
    """Zero-padded to at least ``width``; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def branch_code(number: Column, branches: int = 50) -> Column:
    """``0001`` .. ``0050`` by modulus."""
    return F.lpad((number % branches + 1).cast("string"), 4, "0")


def first_divisor(number: Column, rules: Sequence[tuple[int, str]], default: str) -> Column:
    """The label of the first rule whose divisor divides the number."""
    chain = None
    for divisor, label in rules:
        hit = number % divisor == 0
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(default)


def by_remainder(
    number: Column, rules: Sequence[tuple[int, int, str]], default: str
) -> Column:
    """The label of the first rule (divisor, remainder, label) that fits the number."""
    chain = None
    for divisor, remainder, label in rules:
        hit = number % divisor == remainder
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(default)


def band(number: Column, upper_bounds: Sequence[tuple[int, str]], default: str) -> Column:
    """The label of the first band whose exclusive upper bound exceeds the number."""
    chain = None
    for bound, label in upper_bounds:
        hit = number < bound
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(default)
