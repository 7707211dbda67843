"""Money: doubles in the raw zone, whole cents as bigint where amounts are added up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A two-decimal amount as whole cents, which sum the same in any order."""
    return F.round(amount * 100).cast("bigint")


def amount(whole_cents: Column) -> Column:
    """Cents back to the double that lands in the raw zone."""
    return whole_cents / F.lit(100.0)
