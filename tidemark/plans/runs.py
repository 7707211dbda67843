"""Run history: state, roll-ups, watermarks, plans and monitoring reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_id
from tidemark.operators import edits, runs
from tidemark.plans import inputs
from tidemark.plans.inputs import table, with_sql
from tidemark.plans.registry import query
from tidemark.session import staged
from tidemark.sinks import catalog

BUSINESS_MONTH = "1998-06-01"
NOW = "1998-01-01 00:00:00"
WINDOW = ("2024-01-10", "2024-02-05")

_LOG = with_sql(inputs.RUN_LOG_SQL)
_STATE = ["log_id", "run_id", "table_id", "run_dt", "status", "rows_read", "rows_written",
          "started_at", "heartbeat_at", "finished_at", "duration_seconds"]
_STATE_SQL = """SELECT log_id, run_id, table_id, CAST(run_dt AS VARCHAR) AS run_dt, status,
  rows_read, rows_written, CAST(started_at AS VARCHAR) AS started_at,
  CAST(heartbeat_at AS VARCHAR) AS heartbeat_at, CAST(finished_at AS VARCHAR) AS finished_at,
  duration_seconds FROM log"""


def _log(spark, sf_dir):
    return runs.log_state(inputs.run_events(spark, sf_dir))


@query(_LOG + _STATE_SQL)
def latest_log_state(spark, sf_dir):
    """Current state of every load, folded from its events."""
    return _log(spark, sf_dir).select(*_STATE)


@query(
    _LOG
    + """SELECT run_id, CAST(total AS INTEGER) AS total_tables, CAST(ok AS INTEGER)
    AS success_count, CAST(bad AS INTEGER) AS failed_count, CAST(skip AS INTEGER)
    AS skipped_count, CAST(open AS INTEGER) AS open_count,
  CASE WHEN open > 0 THEN 'STARTED' WHEN bad = 0 THEN 'SUCCESS'
    WHEN bad = total THEN 'FAILED' ELSE 'PARTIAL' END AS status
FROM (SELECT run_id, count(*) AS total, sum(CASE status WHEN 'SUCCESS' THEN 1 ELSE 0 END) AS ok,
    sum(CASE status WHEN 'FAILED' THEN 1 ELSE 0 END) AS bad,
    sum(CASE status WHEN 'SKIPPED' THEN 1 ELSE 0 END) AS skip,
    sum(CASE status WHEN 'STARTED' THEN 1 ELSE 0 END) AS open
  FROM log GROUP BY run_id)"""
)
def run_status_rollup(spark, sf_dir):
    """Counts by outcome and the derived status of every run."""
    return runs.run_rollup(_log(spark, sf_dir))


@query(
    _LOG
    + """SELECT table_id, CAST(max(run_dt) AS VARCHAR) AS watermark FROM log
WHERE status = 'SUCCESS' GROUP BY table_id"""
)
def watermark_per_table(spark, sf_dir):
    """The last successfully loaded business date per table."""
    return runs.watermarks(_log(spark, sf_dir))


@query(
    _LOG
    + f"""SELECT log_id, run_id, CAST(heartbeat_at AS VARCHAR) AS heartbeat_at FROM log
WHERE status = 'STARTED' AND heartbeat_at < TIMESTAMP '{NOW}' - INTERVAL 1 DAY"""
)
def orphaned_runs(spark, sf_dir):
    """Open loads that gave no sign of life for a day."""
    now = F.lit(NOW).cast("timestamp_ntz")
    stale = runs.stale_runs(_log(spark, sf_dir), now, F.expr("INTERVAL 1 DAY"))
    return stale.select("log_id", "run_id", "heartbeat_at")


@query(
    with_sql(inputs.REGISTRY_SQL)
    + """SELECT l.table_id, l.process_type, l.load_type, l.depends_on_table_ids,
  r.source_table_name, r.load_priority
FROM layers l JOIN registry r USING (table_id)
WHERE l.is_active AND r.is_active ORDER BY load_priority, table_id, process_type"""
)
def load_plan(spark, sf_dir):
    """Active tables and layers in load order."""
    return runs.load_plan(inputs.feed_registry(spark, sf_dir), inputs.feed_layers(spark, sf_dir))


@query(
    with_sql(inputs.REGISTRY_SQL, inputs.FEED_LOG_SQL)
    + f""", done AS (
  SELECT DISTINCT table_id AS upstream FROM feed_log
  WHERE run_dt = DATE '{BUSINESS_MONTH}' AND status = 'SUCCESS'),
needs AS (
  SELECT table_id, process_type, TRY_CAST(trim(part) AS BIGINT) AS upstream
  FROM layers, unnest(coalesce(string_split(depends_on_table_ids, ','), [NULL])) AS s(part))
SELECT table_id, process_type, count(n.upstream) AS upstreams,
  count(d.upstream) AS ready_upstreams, count(n.upstream) = count(d.upstream) AS is_ready
FROM needs n LEFT JOIN done d ON n.upstream = d.upstream GROUP BY table_id, process_type""".replace(
        "\n, done", ", done"
    )
)
def upstream_ready(spark, sf_dir):
    """Whether all upstream feeds of a layer succeeded for a business date."""
    return runs.upstream_ready(
        inputs.feed_layers(spark, sf_dir), inputs.feed_log(spark, sf_dir), BUSINESS_MONTH
    )


@query(
    with_sql(inputs.FEED_SQL)
    + """SELECT table_name, CAST(dt AS VARCHAR) AS dt, records, previous,
  records - previous AS change
FROM (SELECT *, lag(records) OVER (PARTITION BY table_name ORDER BY dt) AS previous
  FROM (SELECT event_type AS table_name, dt, count(*) AS records FROM feed GROUP BY 1, 2))"""
)
def volume_day_over_day(spark, sf_dir):
    """Records per feed and day against the day before."""
    counts = (
        inputs.feed(spark, sf_dir)
        .groupBy(F.col("event_type").alias("table_name"), "dt")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return runs.volume_change(counts).select("table_name", "dt", "records", "previous", "change")


@query(
    """
SELECT l_orderkey AS log_id, CAST(sum(copies) AS BIGINT) AS rows_read,
  count(*) AS rows_written, CAST(sum(copies) - count(*) AS BIGINT) AS difference,
  sum(copies) = count(*) AS is_balanced
FROM (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2)
GROUP BY l_orderkey"""
)
def read_write_reconcile(spark, sf_dir):
    """Rows read against rows left after de-duplication, per load."""
    per_key = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    counts = per_key.groupBy(F.col("l_orderkey").alias("log_id")).agg(
        F.sum("copies").alias("rows_read"), F.count(F.lit(1)).alias("rows_written")
    )
    return runs.reconcile(counts)


@query(
    _LOG
    + """SELECT table_id, CAST(date_trunc('month', run_dt)::DATE AS VARCHAR) AS period,
  count(*) AS loads, count(*) FILTER (WHERE status = 'SUCCESS') AS successes,
  count(*) FILTER (WHERE status = 'FAILED') AS failures,
  CAST(sum(duration_seconds) AS BIGINT) AS total_seconds,
  max(duration_seconds) AS longest_seconds, CAST(sum(rows_written) AS BIGINT) AS rows_written
FROM log GROUP BY 1, 2"""
)
def run_history_trend(spark, sf_dir):
    """Monthly outcome, duration and volume per table."""
    return runs.history_trend(_log(spark, sf_dir), F.trunc("run_dt", "month"))


@query(
    _LOG
    + """SELECT table_id, count(*) AS loads, CAST(sum(duration_seconds) AS BIGINT)
  AS total_seconds, max(duration_seconds) AS longest_seconds
FROM log WHERE status = 'SUCCESS' GROUP BY table_id
ORDER BY total_seconds DESC, table_id LIMIT 3"""
)
def slowest_tables(spark, sf_dir):
    """The three tables that take the most time."""
    return (
        _log(spark, sf_dir)
        .where(F.col("status") == "SUCCESS")
        .groupBy("table_id")
        .agg(
            F.count(F.lit(1)).alias("loads"),
            F.sum("duration_seconds").alias("total_seconds"),
            F.max("duration_seconds").alias("longest_seconds"),
        )
        .orderBy(F.desc("total_seconds"), "table_id")
        .limit(3)
    )


@query(
    with_sql(inputs.FEED_SQL)
    + f"""
, days AS (
  SELECT CAST(d AS DATE) AS run_dt FROM generate_series(DATE '{WINDOW[0]}', DATE '{WINDOW[1]}',
    INTERVAL 1 DAY) AS s(d)),
loaded AS (
  SELECT DISTINCT user_id AS table_id, dt AS run_dt FROM feed WHERE event_type = 'purchase')
SELECT u.table_id, CAST(days.run_dt AS VARCHAR) AS run_dt
FROM (SELECT DISTINCT user_id AS table_id FROM feed) u CROSS JOIN days
WHERE NOT EXISTS (SELECT 1 FROM loaded l
  WHERE l.table_id = u.table_id AND l.run_dt = days.run_dt)"""
)
def backfill_dates_missing(spark, sf_dir):
    """Dates of a window that a feed has not loaded; a purchase counts as a load."""
    events = inputs.feed(spark, sf_dir)
    log = events.select(
        F.col("user_id").alias("table_id"),
        F.col("dt").alias("run_dt"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("FAILED").alias("status"),
    )
    return runs.missing_dates(log, log.select("table_id").distinct(), *WINDOW)


@query(
    with_sql(inputs.FEED_SQL)
    + f"""
, days AS (
  SELECT CAST(d AS DATE) AS run_dt FROM generate_series(DATE '{WINDOW[0]}', DATE '{WINDOW[1]}',
    INTERVAL 1 DAY) AS s(d)),
counts AS (SELECT user_id AS table_id, dt AS run_dt, count(*) AS n FROM feed GROUP BY 1, 2)
SELECT u.table_id, CAST(days.run_dt AS VARCHAR) AS run_dt, coalesce(n, 0) AS rows_read,
  CASE WHEN n IS NULL THEN 'SKIPPED' ELSE 'SUCCESS' END AS status
FROM (SELECT DISTINCT user_id AS table_id FROM feed) u CROSS JOIN days
LEFT JOIN counts c ON c.table_id = u.table_id AND c.run_dt = days.run_dt"""
)
def load_outcomes(spark, sf_dir):
    """SUCCESS or, where a source delivered nothing, SKIPPED, per feed and date of a window."""
    events = inputs.feed(spark, sf_dir)
    arrived = events.select(F.col("user_id").alias("table_id"), F.col("dt").alias("run_dt"))
    feeds = arrived.select("table_id").distinct()
    return runs.load_outcomes(arrived, *WINDOW, feeds=feeds)


@query(
    with_sql(inputs.REGISTRY_SQL)
    + """SELECT l.table_id, l.process_type, l.load_type, r.source_table_name, r.load_priority,
  l.process_type = 'SILVER' AS is_lowered, CAST(6 AS BIGINT) AS metadata_tables
FROM layers l JOIN registry r USING (table_id) WHERE l.is_active AND r.is_active"""
)
def catalogued_configuration(spark, sf_dir):
    """Configuration inserted into metadata tables of the catalog, edited there and asked by parameter."""
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    database = f"{prefix}metadata"
    layers = catalog.create_layers(spark, prefix)
    try:
        catalog.create_metadata_tables(spark, database)
        tables = catalog.describe(spark, database).select("table_name").distinct().count()
        catalog.insert_rows(inputs.feed_registry(spark, sf_dir), f"{database}.table_config")
        rules = inputs.feed_layers(spark, sf_dir).withColumn("process_config_id", surrogate_id("table_id", "process_type"))
        stored = f"{database}.table_process_config"
        catalog.insert_rows(rules, stored)
        silver = F.col("process_type") == "SILVER"
        catalog.replace_rows(edits.updated(spark.table(stored), silver, {"created_by": F.lit("lowered")}), stored)
        spark.catalog.refreshTable(stored)
        asked = catalog.query(
            spark,
            f"""SELECT l.table_id, l.process_type, l.load_type, r.source_table_name, r.load_priority,
              coalesce(l.created_by = :mark, false) AS is_lowered, CAST(:tables AS BIGINT) AS metadata_tables
            FROM {stored} l JOIN {database}.table_config r ON l.table_id = r.table_id
            WHERE l.is_active AND r.is_active""",
            mark="lowered", tables=tables,
        )
        return staged(asked, "catalogued")
    finally:
        catalog.drop_metadata_tables(spark, database)
        for name in layers:
            spark.sql(f"DROP DATABASE IF EXISTS `{name}`")
