"""Row history: validity intervals, differences between batches, joins as of a day."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.dedup import latest_per_key
from tidemark.plans import inputs
from tidemark.plans.inputs import with_sql
from tidemark.plans.registry import query

MIDDLE = "2024-01-16"


def _states(spark, sf_dir, where="true"):
    """The last event of each user and day."""
    feed = inputs.feed(spark, sf_dir).where(where)
    return latest_per_key(feed, ["user_id", "dt"], ["ts", "event_id"]).select("user_id", "dt", "event_type", "value")


def _states_sql(name: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT user_id, dt, event_type, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, dt ORDER BY ts DESC, event_id DESC) AS r FROM feed WHERE {where}) WHERE r = 1)"""


@query(
    with_sql(inputs.FEED_SQL, _states_sql("states"))
    + """, marked AS (
  SELECT *, event_type IS DISTINCT FROM lag(event_type) OVER w
    OR row_number() OVER w = 1 AS is_new FROM states WINDOW w AS (PARTITION BY user_id ORDER BY dt))
SELECT user_id, event_type, CAST(dt AS VARCHAR) AS valid_from,
  CAST(lead(dt) OVER (PARTITION BY user_id ORDER BY dt) AS VARCHAR) AS valid_to FROM marked WHERE is_new"""
)
def validity_history(spark, sf_dir):
    """From when until when each user's last event was of one type."""
    return history.validity(_states(spark, sf_dir), ["user_id"], "dt", ["event_type"])


@query(
    with_sql(inputs.FEED_SQL)
    + """, batches AS (SELECT dt, lead(dt) OVER (ORDER BY dt) AS next_dt FROM (SELECT DISTINCT dt FROM feed)),
rows AS (
  SELECT user_id, dt, next_dt, bought FROM (
    SELECT user_id, dt, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS bought FROM feed GROUP BY user_id, dt)
  JOIN batches USING (dt)),
marked AS (
  SELECT *, CASE WHEN lag(bought) OVER w IS DISTINCT FROM bought OR lag(next_dt) OVER w IS DISTINCT FROM dt
    THEN 1 ELSE 0 END AS is_new FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY dt)),
numbered AS (SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY dt) AS version FROM marked)
SELECT user_id, any_value(bought) AS bought, CAST(min(dt) AS VARCHAR) AS valid_from,
  CAST(arg_max(next_dt, dt) AS VARCHAR) AS valid_to
FROM (SELECT * REPLACE (coalesce(next_dt, DATE '9999-12-31') AS next_dt) FROM numbered) GROUP BY user_id, version""".replace(
        "CAST(arg_max(next_dt, dt) AS VARCHAR)", "CAST(nullif(arg_max(next_dt, dt), DATE '9999-12-31') AS VARCHAR)"
    )
)
def snapshot_history(spark, sf_dir):
    """The same from whole daily snapshots: a user whom a day lacks ends there."""
    bought = F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("bought")
    daily = inputs.feed(spark, sf_dir).groupBy("user_id", "dt").agg(bought)
    return history.validity(daily, ["user_id"], "dt", ["bought"], snapshots=True)


def _halves(spark, sf_dir):
    states = _states(spark, sf_dir)
    before, after = states.where(f"dt < DATE '{MIDDLE}'"), states.where(f"dt >= DATE '{MIDDLE}'")
    return [latest_per_key(half, ["user_id"], ["dt"]) for half in (before, after)]


@query(
    with_sql(inputs.FEED_SQL, _states_sql("states"))
    + f""", latest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, dt < DATE '{MIDDLE}' ORDER BY dt DESC) AS r FROM states),
old AS (SELECT * FROM latest WHERE dt < DATE '{MIDDLE}' AND r = 1),
new AS (SELECT * FROM latest WHERE dt >= DATE '{MIDDLE}' AND r = 1),
compared AS (
  SELECT coalesce(o.user_id, n.user_id) AS user_id, o.user_id AS was, n.user_id AS is_now,
    o.event_type IS DISTINCT FROM n.event_type AS kind, o.value IS DISTINCT FROM n.value AS amount
  FROM old o FULL JOIN new n ON o.user_id = n.user_id)
SELECT user_id, CASE WHEN was IS NULL THEN 'INSERT' WHEN is_now IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change,
  CASE WHEN was IS NULL OR is_now IS NULL THEN '' ELSE concat_ws(',', CASE WHEN kind THEN 'event_type' END,
    CASE WHEN amount THEN 'value' END) END AS changed
FROM compared WHERE was IS NULL OR is_now IS NULL OR kind OR amount"""
)
def batch_difference(spark, sf_dir):
    """Users that came, went or changed between two states of the feed, and in what."""
    before, after = _halves(spark, sf_dir)
    found = history.difference(before, after, ["user_id"], ["event_type", "value"])
    return found.withColumn("changed", F.array_join("changed", ","))


@query(
    with_sql(inputs.FEED_SQL, _states_sql("states", "event_type = 'purchase'"))
    + """, banded AS (SELECT user_id, dt, CAST(floor(value / 100) AS BIGINT) AS band FROM states),
marked AS (
  SELECT *, band IS DISTINCT FROM lag(band) OVER w OR row_number() OVER w = 1 AS is_new
  FROM banded WINDOW w AS (PARTITION BY user_id ORDER BY dt)),
versions AS (
  SELECT user_id, band, dt AS valid_from, lead(dt) OVER (PARTITION BY user_id ORDER BY dt) AS valid_to
  FROM marked WHERE is_new)
SELECT f.event_id, f.user_id, CAST(f.dt AS VARCHAR) AS dt, v.band
FROM feed f LEFT JOIN versions v ON v.user_id = f.user_id AND f.dt >= v.valid_from
  AND (v.valid_to IS NULL OR f.dt < v.valid_to)"""
)
def as_of_attributes(spark, sf_dir):
    """Every event with the band of the user's last purchase up to that day."""
    bought = _states(spark, sf_dir, "event_type = 'purchase'")
    banded = bought.select("user_id", "dt", F.floor(F.col("value") / 100).alias("band"))
    versions = history.validity(banded, ["user_id"], "dt", ["band"])
    facts = inputs.feed(spark, sf_dir).select("event_id", "user_id", "dt")
    return history.as_of_join(facts, versions, ["user_id"], "dt", ["band"])
