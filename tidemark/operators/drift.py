"""Schema drift: detect it per landed batch, then reject, evolve or quarantine.

Only schemas (file footers) are compared on the driver; rows stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import hash_key
from tidemark.schemas import METADATA_SCHEMAS

STRICT, EVOLVE, QUARANTINE = "STRICT", "EVOLVE", "QUARANTINE"
DEFAULT_POLICY = STRICT


@dataclass(frozen=True)
class Finding:
    """A column that differs; ``data_type`` is the source's, or the target's if missing."""

    column: str
    data_type: str
    event: str


class SchemaDrift(ValueError):
    def __init__(self, findings: Sequence[Finding]):
        self.findings = list(findings)
        listed = ", ".join(f"{f.event} {f.column} {f.data_type}" for f in findings)
        super().__init__(f"schema drift: {listed}")


@dataclass
class DriftOutcome:
    accepted: DataFrame | None
    quarantined: DataFrame | None
    findings: list[Finding]


def find_drift(source: T.StructType, target: T.StructType) -> list[Finding]:
    """NEW, MISSING and TYPE_CHANGED columns; names compare without case, as in Spark."""
    there = {f.name.lower(): f for f in target.fields}
    here = {f.name.lower(): f for f in source.fields}
    found = [
        Finding(f.name, f.dataType.simpleString(), "NEW")
        for key, f in here.items()
        if key not in there
    ]
    found += [
        Finding(f.name, f.dataType.simpleString(), "MISSING")
        for key, f in there.items()
        if key not in here
    ]
    found += [
        Finding(f.name, f.dataType.simpleString(), "TYPE_CHANGED")
        for key, f in here.items()
        if key in there and f.dataType != there[key].dataType
    ]
    return sorted(found, key=lambda f: (f.event, f.column))


def action_for(policy: str, event: str) -> str:
    """EVOLVE can add and null-fill columns, but not change a type."""
    if policy == QUARANTINE:
        return "QUARANTINED"
    if policy == EVOLVE and event != "TYPE_CHANGED":
        return "AUTO_EVOLVED"
    return "REJECTED"


def conform(df: DataFrame, target: T.StructType, keep_new: bool = True) -> DataFrame:
    """Target columns first, missing ones as typed NULLs, then new ones."""
    here = {c.lower(): c for c in df.columns}
    known = {f.name.lower() for f in target.fields}
    columns = [
        F.col(here[f.name.lower()]).alias(f.name)
        if f.name.lower() in here
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    if keep_new:
        columns += [F.col(c) for c in df.columns if c.lower() not in known]
    return df.select(*columns)


def apply_policy(df: DataFrame, target: T.StructType, policy: str = DEFAULT_POLICY) -> DriftOutcome:
    """What becomes of a batch under a drift policy.

    STRICT raises on any difference.  EVOLVE returns the batch in the widened
    layout and raises if a type changed.  QUARANTINE parks every row of the
    batch as JSON next to the reason, so batches of any shape fit one table.
    """
    findings = find_drift(df.schema, target)
    if not findings:
        return DriftOutcome(conform(df, target), None, [])
    if policy == QUARANTINE:
        reason = "; ".join(f"{f.event}:{f.column}:{f.data_type}" for f in findings)
        parked = df.select(
            F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("payload"),
            F.lit(reason).alias("drift_reason"),
        )
        return DriftOutcome(None, parked, findings)
    refused = [f for f in findings if action_for(policy, f.event) == "REJECTED"]
    if refused:
        raise SchemaDrift(refused)
    return DriftOutcome(conform(df, target), None, findings)


def evolved_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Batches of different width under one another; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def drift_log_rows(
    spark: SparkSession,
    findings: Sequence[Finding],
    run_id: str,
    table_id: int,
    policy: str,
    detected_at: str,
    created_by: str = "manual",
) -> DataFrame:
    """Findings in the layout of ``schema_drift_log``, ids derived from their content."""
    schema = T.StructType(
        [
            T.StructField("column_name", T.StringType(), False),
            T.StructField("column_data_type", T.StringType()),
            T.StructField("event_type", T.StringType(), False),
            T.StructField("action_taken", T.StringType(), False),
        ]
    )
    rows = [(f.column, f.data_type, f.event, action_for(policy, f.event)) for f in findings]
    at = F.lit(detected_at).cast("timestamp")
    df = spark.createDataFrame(rows, schema).withColumns(
        {
            "run_id": F.lit(run_id),
            "table_id": F.lit(table_id).cast("bigint"),
            "detected_at": at,
            "created_by": F.lit(created_by),
            "created_at": at,
            "updated_at": at,
            "drift_log_id": hash_key(F.lit(run_id), F.lit(table_id), "column_name", "event_type"),
        }
    )
    return df.select(*METADATA_SCHEMAS["schema_drift_log"].fieldNames())
