"""Run history: fold events to state, roll runs up, derive watermarks and reports.

The run log is append-only.  A log entry's state is an aggregate over its
events (combined map-side), not an update in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged

MAX_BACKFILL_DAYS = 30
TERMINAL = ["SUCCESS", "FAILED", "SKIPPED", "QUARANTINED"]
_STATUSES = ["STARTED", *TERMINAL]


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end; works for zoned and zone-less timestamps."""
    return F.timestamp_diff("SECOND", *[F.col(c) if isinstance(c, str) else c for c in (start, end)])


def log_state(events: DataFrame) -> DataFrame:
    """Current state per ``log_id``.

    Events: ``log_id, run_id, table_id, run_dt, seq, status, rows_read,
    rows_written, at``.  Columns an event leaves NULL keep their earlier value;
    the status is that of the highest ``seq``.  Order and status travel as one
    number, which lets the fold run as a hash aggregate instead of a sort.
    """
    done = F.col("status").isin(*TERMINAL)
    statuses = F.array(*[F.lit(s) for s in _STATUSES])
    ranked = F.col("seq").cast("bigint") * 8 + F.array_position(statuses, F.col("status"))
    return (
        events.groupBy("log_id")
        .agg(
            F.max("run_id").alias("run_id"),
            F.max("table_id").alias("table_id"),
            F.max("run_dt").alias("run_dt"),
            F.max(ranked).alias("ranked"),
            F.max_by("rows_read", F.when(F.col("rows_read").isNotNull(), F.col("seq"))).alias(
                "rows_read"
            ),
            F.max_by(
                "rows_written", F.when(F.col("rows_written").isNotNull(), F.col("seq"))
            ).alias("rows_written"),
            F.min(F.when(F.col("seq") == 0, F.col("at"))).alias("started_at"),
            F.max("at").alias("heartbeat_at"),
            F.max(F.when(done, F.col("at"))).alias("finished_at"),
        )
        .withColumns(
            {
                "status": F.element_at(statuses, (F.col("ranked") % 8).cast("int")),
                "duration_seconds": seconds_between("started_at", "finished_at"),
            }
        )
        .drop("ranked")
    )


def run_rollup(log: DataFrame) -> DataFrame:
    """Per run: counts by status and the run's own status.

    STARTED while any table is open; otherwise SUCCESS without a failure, FAILED
    if every table failed, PARTIAL in between.  A run with no table has no row.
    """
    def times(status: str) -> Column:
        return F.count_if(F.col("status") == status).cast("int")

    counted = log.groupBy("run_id").agg(
        F.count(F.lit(1)).cast("int").alias("total_tables"),
        times("SUCCESS").alias("success_count"),
        times("FAILED").alias("failed_count"),
        times("SKIPPED").alias("skipped_count"),
        F.count_if(~F.col("status").isin(*TERMINAL)).cast("int").alias("open_count"),
    )
    return counted.withColumn(
        "status",
        F.when(F.col("open_count") > 0, "STARTED")
        .when(F.col("failed_count") == 0, "SUCCESS")
        .when(F.col("failed_count") == F.col("total_tables"), "FAILED")
        .otherwise("PARTIAL"),
    )


def watermarks(log: DataFrame, table: str = "table_id") -> DataFrame:
    """The last successful business date per table."""
    return (
        log.where(F.col("status") == "SUCCESS")
        .groupBy(table)
        .agg(F.max("run_dt").alias("watermark"))
    )


def stale_runs(log: DataFrame, now: Column, patience: Column) -> DataFrame:
    """Open entries whose last sign of life is older than ``patience`` before ``now``."""
    return log.where(
        (F.col("status") == "STARTED") & (F.col("heartbeat_at") < now - patience)
    )


def load_plan(table_config: DataFrame, process_config: DataFrame) -> DataFrame:
    """Active tables per layer in load order; lower priority numbers first."""
    tables = table_config.where("is_active").select(
        "table_id", "source_table_name", "load_priority"
    )
    layers = process_config.where("is_active").drop("is_active")
    return layers.join(tables, "table_id").orderBy("load_priority", "table_id", "process_type")


def upstream_ready(process_config: DataFrame, log: DataFrame, run_dt: str) -> DataFrame:
    """``table_id, process_type, upstreams, ready_upstreams, is_ready`` for a business date.

    ``depends_on_table_ids`` is a comma list; no list means ready.  A part that is not
    a number names no table that could finish, so it counts as an upstream that is never
    ready; empty parts ("1,,2") name nothing.  The finished tables of one date are
    broadcast if they measure small, so that a table everyone depends on does not become
    one large join group.
    """
    done = (
        log.where((F.col("run_dt") == F.lit(run_dt).cast("date")) & (F.col("status") == "SUCCESS"))
        .select(F.col("table_id").alias("upstream"), F.lit(True).alias("done"))
        .distinct()
    )
    done = broadcast_if_small(staged(done, "finished-tables"))
    needs = process_config.select(
        "table_id",
        "process_type",
        F.explode_outer(F.split("depends_on_table_ids", ",")).alias("part"),
    ).select(
        "table_id",
        "process_type",
        (F.trim("part") != "").alias("named"),
        F.trim("part").try_cast("bigint").alias("upstream"),
    )
    return (
        needs.join(done, "upstream", "left")
        .groupBy("table_id", "process_type")
        .agg(
            F.count_if("named").alias("upstreams"),
            F.count("done").alias("ready_upstreams"),
        )
        .withColumn("is_ready", F.col("upstreams") == F.col("ready_upstreams"))
    )


def missing_dates(
    log: DataFrame, feeds: DataFrame, start: str, end: str, limit: int = MAX_BACKFILL_DAYS
) -> DataFrame:
    """Dates of the backfill window (inclusive) a feed has not loaded successfully.

    ``feeds``: distinct ``table_id``.  A window of more than ``limit`` days is an error,
    so the expected grid is feeds times ``limit`` at most.
    """
    expected = feeds.withColumn("run_dt", F.explode(backfill_dates(start, end, limit)))
    done = log.where(
        (F.col("status") == "SUCCESS")
        & F.col("run_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ).select("table_id", "run_dt")
    return expected.join(done.distinct(), ["table_id", "run_dt"], "left_anti")


def load_outcomes(
    arrived: DataFrame,
    start: str,
    end: str,
    feeds: DataFrame | None = None,
    limit: int = MAX_BACKFILL_DAYS,
) -> DataFrame:
    """``table_id, run_dt, rows_read, status`` for every feed and date of a window.

    ``arrived``: ``table_id, run_dt`` per source row, of which only the window is
    counted.  ``feeds``: the registered ``table_id``; all that ever arrived if left out.
    A source without rows is SKIPPED.
    """
    window = F.col("run_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    counts = arrived.where(window).groupBy("table_id", "run_dt").agg(F.count(F.lit(1)).alias("rows_read"))
    feeds = arrived.select("table_id").distinct() if feeds is None else feeds
    expected = feeds.withColumn("run_dt", F.explode(backfill_dates(start, end, limit)))
    return expected.join(counts, ["table_id", "run_dt"], "left").select(
        "table_id",
        "run_dt",
        F.coalesce("rows_read", F.lit(0)).alias("rows_read"),
        F.when(F.col("rows_read").isNull(), "SKIPPED").otherwise("SUCCESS").alias("status"),
    )


def backfill_dates(start: str, end: str, limit: int = MAX_BACKFILL_DAYS) -> Column:
    """The array of dates from start to end, both included; more than ``limit`` is an error."""
    from datetime import date

    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if days < 1:
        raise ValueError(f"backfill ends before it starts: {start} .. {end}")
    if days > limit:
        raise ValueError(f"backfill of {days} days exceeds the limit of {limit}")
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))


def volume_change(counts: DataFrame) -> DataFrame:
    """Rows per table and date against the date before.

    ``counts``: ``table_name, dt, records``, already aggregated, so a window holds
    one row per calendar day of one table.
    """
    by_day = Window.partitionBy("table_name").orderBy("dt")
    return counts.withColumn("previous", F.lag("records").over(by_day)).withColumn(
        "change", F.col("records") - F.col("previous")
    )


def history_trend(log: DataFrame, period: Column) -> DataFrame:
    """Outcome counts, duration and volume per table and period."""
    return log.groupBy(F.col("table_id"), period.alias("period")).agg(
        F.count(F.lit(1)).alias("loads"),
        F.count_if(F.col("status") == "SUCCESS").alias("successes"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.sum("duration_seconds").alias("total_seconds"),
        F.max("duration_seconds").alias("longest_seconds"),
        F.sum("rows_written").alias("rows_written"),
    )


def reconcile(written: DataFrame) -> DataFrame:
    """Adds the difference between rows read and rows written."""
    lost = F.col("rows_read") - F.col("rows_written")
    return written.withColumn("difference", lost).withColumn("is_balanced", lost == 0)
