"""Schema drift between deliveries of the event feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators import drift, release
from tidemark.operators import nested_drift as nested
from tidemark.operators.joins import union_all
from tidemark.plans import inputs
from tidemark.plans.inputs import table
from tidemark.plans.registry import query
from tidemark.session import work_path
from tidemark.sinks import tables
from tidemark.sinks.tables import write_batch
from tidemark.sources.landing import read_batch, read_partitioned

RUN_DT = "2024-01-30"
TABLE_ID = 1
DETECTED_AT = "2024-01-31 00:00:00"

# Delivery 1 is as agreed, 2 brings a new column and lacks one, 3 changes a type.
_SHIFT_SQL = """WITH shifts AS (
  SELECT *, CASE WHEN hour(ts) < 8 THEN 1 WHEN hour(ts) < 16 THEN 2 ELSE 3 END AS delivery
  FROM events),
counts AS (SELECT delivery, count(*) AS records FROM shifts GROUP BY delivery)
"""
_FINDINGS_SQL = """findings(batch, column_name, column_data_type, event_type, action_taken) AS (
  VALUES (2, 'channel', 'string', 'NEW', 'AUTO_EVOLVED'),
         (2, 'props', 'string', 'MISSING', 'AUTO_EVOLVED'),
         (3, 'user_id', 'string', 'TYPE_CHANGED', 'REJECTED'))
"""

_landed_roots: dict[tuple[str, str], str] = {}


def deliveries(spark, sf_dir):
    """Three batch folders of one date, landed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed_roots:
        root = work_path(spark, "drifting")
        events = table(spark, sf_dir, "events")
        hour = F.hour("ts")
        frames = {
            1: events.where(hour < 8),
            2: events.where((hour >= 8) & (hour < 16))
            .withColumn("channel", F.concat(F.col("event_type"), F.lit("-web")))
            .drop("props"),
            3: events.where(hour >= 16).withColumn("user_id", F.col("user_id").cast("string")),
        }
        for batch, df in frames.items():
            write_batch(df, root, "events", RUN_DT, batch)
        _landed_roots[key] = root
    root = _landed_roots[key]
    return {n: read_batch(spark, root, "events", RUN_DT, n) for n in (1, 2, 3)}


def _events(spark, sf_dir):
    """Drift log rows of all deliveries with the rows they concern."""
    target = table(spark, sf_dir, "events").schema
    logs, counts = [], []
    for batch, df in deliveries(spark, sf_dir).items():
        findings = drift.find_drift(df.schema, target)
        run_id = f"run-{batch}"
        if findings:
            logs.append(
                drift.drift_log_rows(
                    spark, findings, run_id, TABLE_ID, drift.EVOLVE, DETECTED_AT
                )
            )
        counts.append(
            df.agg(
                F.lit(run_id).alias("run_id"),
                F.lit(batch).alias("batch"),
                F.count(F.lit(1)).alias("records"),
            )
        )
    return union_all(logs).join(union_all(counts), "run_id")


@query(
    _SHIFT_SQL.rstrip()
    + ",\n"
    + _FINDINGS_SQL
    + """SELECT batch, column_name, column_data_type, event_type, action_taken, records
FROM findings JOIN counts ON batch = delivery"""
)
def drift_events(spark, sf_dir):
    """New, missing and changed columns per delivery, with the action an evolving table takes."""
    return _events(spark, sf_dir).select(
        "batch", "column_name", "column_data_type", "event_type", "action_taken", "records"
    )


@query(
    _SHIFT_SQL.rstrip()
    + ",\n"
    + _FINDINGS_SQL
    + """SELECT event_type, action_taken, count(*) AS findings,
  CAST(sum(records) AS BIGINT) AS records
FROM findings JOIN counts ON batch = delivery GROUP BY 1, 2"""
)
def drift_history(spark, sf_dir):
    """Findings and rows concerned by kind and action."""
    return (
        _events(spark, sf_dir)
        .groupBy("event_type", "action_taken")
        .agg(F.count(F.lit(1)).alias("findings"), F.sum("records").alias("records"))
    )


@query(
    _SHIFT_SQL
    + """SELECT event_id, user_id, event_type, value,
  CASE WHEN delivery = 1 THEN props END AS props,
  CASE WHEN delivery = 2 THEN event_type || '-web' END AS channel
FROM shifts WHERE delivery < 3"""
)
def evolved_union(spark, sf_dir):
    """Two deliveries of different width as one table."""
    target = table(spark, sf_dir, "events").schema
    frames = deliveries(spark, sf_dir)
    accepted = [
        drift.apply_policy(frames[n], target, drift.EVOLVE).accepted for n in (1, 2)
    ]
    return drift.evolved_union(accepted).select(
        "event_id", "user_id", "event_type", "value", "props", "channel"
    )


@query(
    _SHIFT_SQL
    + """SELECT event_id, CASE delivery WHEN 2 THEN 'MISSING:props:string; NEW:channel:string'
  ELSE 'TYPE_CHANGED:user_id:string' END AS drift_reason
FROM shifts WHERE delivery > 1"""
)
def quarantined_rows(spark, sf_dir):
    """Rows of drifted deliveries parked under the quarantine policy."""
    target = table(spark, sf_dir, "events").schema
    outcomes = [
        drift.apply_policy(df, target, drift.QUARANTINE)
        for df in deliveries(spark, sf_dir).values()
    ]
    parked = [o.quarantined for o in outcomes if o.quarantined is not None]
    return reduce(lambda a, b: a.unionByName(b), parked).select(
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
        "drift_reason",
    )


def _nested_events(spark, sf_dir):
    """Events as nested records, as agreed and as a later delivery has them."""
    events = table(spark, sf_dir, "events")
    agreed = events.select(
        "event_id", "user_id", "event_type",
        F.struct("value", F.struct(F.col("ts").alias("at"), F.lit("web").alias("channel")).alias("origin")).alias("body"),
        F.array(F.struct(F.col("value").alias("amount"), F.col("event_type").alias("kind"))).alias("parts"),
    )
    later = events.select(
        "event_id", F.col("user_id").alias("customer"), F.concat("event_type", F.lit("!")).alias("label"),
        F.struct(F.col("value").cast("string").alias("value"), F.struct(F.col("ts").alias("at"), F.lit(1).alias("region")).alias("origin")).alias("body"),
        F.array(F.struct(F.col("value").alias("amount"), F.col("event_type").alias("kind"), F.lit(True).alias("last"))).alias("parts"),
    )
    return agreed, later


@query(
    """
SELECT column_name, event_type, rows FROM (VALUES ('body.origin.channel', 'MISSING'), ('event_type', 'MISSING'),
  ('user_id', 'MISSING'), ('body.origin.region', 'NEW'), ('customer', 'NEW'), ('label', 'NEW'),
  ('parts[].last', 'NEW'), ('body.value', 'TYPE_CHANGED')) AS f(column_name, event_type),
  (SELECT count(*) AS rows FROM events)"""
)
def nested_drift(spark, sf_dir):
    """Changed places at any depth of a nested delivery, with the rows they concern."""
    agreed, later = _nested_events(spark, sf_dir)
    found = nested.find_nested_drift(later.schema, agreed.schema)
    listed = spark.createDataFrame([(f.column, f.event) for f in found], "column_name string, event_type string")
    return listed.withColumn("rows", F.lit(later.count()).cast("bigint"))


@query(
    """SELECT user_id, count(*) AS events FROM events GROUP BY user_id"""
)
def renamed_column(spark, sf_dir):
    """Counts by a key that a delivery brought under another name, found by its values."""
    agreed, later = _nested_events(spark, sf_dir)
    renames = nested.find_renames(later, agreed)
    return nested.with_renames(later, renames).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


@query(
    """
SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 7 = 0 THEN 'late-' || CAST(event_id % 10 AS VARCHAR) END AS channel
FROM events WHERE event_id % 7 <> 0 OR event_id % 11 <> 0"""
)
def released_rows(spark, sf_dir):
    """A table after parked rows fitted its widened layout; those that still don't stay parked."""
    target, parked = work_path(spark, "released"), work_path(spark, "parked")
    columns = ["event_id", "user_id", "event_type", "value"]
    events = table(spark, sf_dir, "events").select(*columns)
    tables.full_refresh(events.where("event_id % 7 <> 0"), target)
    late = events.where("event_id % 7 = 0").withColumn("channel", F.concat(F.lit("late-"), (F.col("event_id") % 10).cast("string")))
    wrong = F.when(F.col("event_id") % 11 == 0, F.lit("unreadable")).otherwise(F.col("user_id").cast("string"))
    outcome = drift.apply_policy(late.withColumn("user_id", wrong), events.schema, drift.QUARANTINE)
    tables.append(outcome.quarantined.withColumn("run_dt", F.lit(RUN_DT).cast("date")), parked, ["run_dt"])
    release.release(spark, parked, target)  # nothing fits yet
    tables.append(events.where("false").withColumn("channel", F.lit("")), target)
    release.release(spark, parked, target)
    release.release(spark, parked, target)
    return read_partitioned(spark, target).select(*columns, "channel")
