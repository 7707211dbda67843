import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.sinks.run_log import RunLog
from tidemark.sources import landing


def test_audit_round_trip(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.runs().count() == 0
    run_id = log.start_etl_run("nightly", "BRONZE", "2024-01-01")
    with pytest.raises(ValueError, match="no row"):
        log.end_etl_run(run_id)
    first = log.log_table_start(run_id, 1, "t_Client", "BRONZE", "FULL", "2024-01-01")
    second = log.log_table_start(run_id, 2, "t_Loan", "BRONZE", "FULL", "2024-01-01", 4)
    assert log.end_etl_run(run_id) == "STARTED"
    log.heartbeat(first)
    log.log_table_end(first, "SUCCESS", 100, 100, 1)
    log.log_table_end(second, "FAILED", 100, error_message="boom")
    assert log.end_etl_run(run_id, "one table failed") == "PARTIAL"
    run = log.runs().first()
    assert (run.status, run.total_tables, run.success_count, run.failed_count) == ("PARTIAL", 2, 1, 1)
    assert run.finished_at is not None and run.pipeline_name == "nightly"
    loads = {r.table_id: r for r in log.loads().collect()}
    assert (loads[1].rows_read, loads[1].rows_written, loads[1].status) == (100, 100, "SUCCESS")
    assert (loads[2].delta_version_before, loads[2].error_message) == (4, "boom")
    assert loads[1].duration_seconds >= 0
    assert landing.high_water_mark(
        log.loads().withColumn("run_dt", F.col("run_dt").cast("date")), 1
    ) == dt.date(2024, 1, 1)
    for bad in ({"process_type": "X"}, {"trigger_type": "CRON"}):
        with pytest.raises(ValueError):
            log.start_etl_run(**{"pipeline_name": "p", "process_type": "BRONZE", "run_dt": "d", **bad})
    with pytest.raises(ValueError):
        log.log_table_end(first, "STARTED")


@pytest.mark.parametrize(
    "statuses, expected",
    [
        (["SUCCESS", "SUCCESS"], "SUCCESS"),
        (["SUCCESS", "SKIPPED"], "SUCCESS"),
        (["FAILED", "FAILED"], "FAILED"),
        (["FAILED", "SKIPPED"], "PARTIAL"),
        (["SUCCESS", "STARTED"], "STARTED"),
    ],
)
def test_run_status(spark, statuses, expected):
    log = spark.createDataFrame([("r", s) for s in statuses], "run_id string, status string")
    assert runs.run_rollup(log).first().status == expected


def test_upstream_ready(spark):
    config = spark.createDataFrame(
        [(1, "BRONZE", None), (2, "SILVER", "1"), (3, "SILVER", "1, 2"), (4, "GOLD", "9")],
        "table_id bigint, process_type string, depends_on_table_ids string",
    )
    day = dt.date(2024, 1, 1)
    log = spark.createDataFrame(
        [(1, day, "SUCCESS"), (2, day, "FAILED"), (9, dt.date(2024, 1, 2), "SUCCESS")],
        "table_id bigint, run_dt date, status string",
    )
    ready = {r.table_id: r.is_ready for r in runs.upstream_ready(config, log, "2024-01-01").collect()}
    assert ready == {1: True, 2: True, 3: False, 4: False}


def test_an_unreadable_upstream_is_never_ready(spark):
    config = spark.createDataFrame(
        [(1, "SILVER", "9,x"), (2, "SILVER", "x"), (3, "SILVER", "9,,"), (4, "SILVER", "")],
        "table_id bigint, process_type string, depends_on_table_ids string",
    )
    log = spark.createDataFrame(
        [(9, dt.date(2024, 1, 1), "SUCCESS")], "table_id bigint, run_dt date, status string"
    )
    got = {r.table_id: (r.upstreams, r.is_ready) for r in runs.upstream_ready(config, log, "2024-01-01").collect()}
    assert got == {1: (2, False), 2: (1, False), 3: (1, True), 4: (0, True)}


def test_backfill_limits():
    with pytest.raises(ValueError, match="limit of 30"):
        runs.backfill_dates("2024-01-01", "2024-01-31")
    with pytest.raises(ValueError, match="before"):
        runs.backfill_dates("2024-01-02", "2024-01-01")


def test_backfill_dates(spark):
    assert spark.range(1).select(runs.backfill_dates("2024-01-01", "2024-01-30").alias("d")).select(
        F.size("d")
    ).first()[0] == 30


def test_stale_runs(spark):
    at = dt.datetime(2024, 1, 1, 12)
    log = spark.createDataFrame(
        [("a", "STARTED", at), ("b", "STARTED", at - dt.timedelta(hours=3)),
         ("c", "SUCCESS", at - dt.timedelta(hours=9))],
        "log_id string, status string, heartbeat_at timestamp_ntz",
    )
    now = F.lit("2024-01-01 13:00:00").cast("timestamp_ntz")
    stale = runs.stale_runs(log, now, F.expr("INTERVAL 2 HOURS"))
    assert [r.log_id for r in stale.collect()] == ["b"]
