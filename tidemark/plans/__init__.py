"""The registered queries.  Importing this package fills the registry."""

from tidemark.plans import (  # noqa: F401
    checks,
    dependencies,
    history,
    landing,
    lending,
    maintenance,
    monitoring,
    portfolio,
    runs,
    schema_changes,
    silver,
)
from tidemark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
