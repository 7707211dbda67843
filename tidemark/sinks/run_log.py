"""The run log: append-only events, read back as current state.

Plain Parquet cannot update a row, and overwriting one would lose the history.
Each call appends one event; the state of a run or table entry is folded from
its events by an aggregate.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import require_single
from tidemark.operators.runs import TERMINAL, run_rollup
from tidemark.schemas import ALLOWED_VALUES, METADATA_SCHEMAS
from tidemark.sinks.tables import compact


def _event_schema(table: str) -> T.StructType:
    """The table's columns, all optional, plus the event's order and time."""
    fields = [T.StructField(f.name, f.dataType) for f in METADATA_SCHEMAS[table].fields]
    return T.StructType(
        [
            *fields,
            T.StructField("stage", T.IntegerType(), False),
            T.StructField("at", T.TimestampType(), False),
        ]
    )


def _check(table: str, **values: str) -> None:
    for column, value in values.items():
        if value not in ALLOWED_VALUES[table][column]:
            raise ValueError(f"{column}: {value!r} is not one of {ALLOWED_VALUES[table][column]}")


class RunLog:
    """Opens and closes runs and table loads below a storage root."""

    MASTER, LOG = "etl_process_master", "etl_process_log"
    _KEY = {MASTER: "run_id", LOG: "log_id"}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._opened: dict[str, tuple[str, datetime]] = {}

    # ---- events --------------------------------------------------------
    def _append(self, table: str, stage: int, **values) -> None:
        now = datetime.now(timezone.utc)
        row = {"stage": stage, "at": now, "updated_at": now, **values}
        schema = _event_schema(table)
        df = self.spark.createDataFrame([tuple(row.get(n) for n in schema.fieldNames())], schema)
        df = df.withColumn("day", F.lit(self._day(table, values)))
        df.coalesce(1).write.mode("append").partitionBy("day").parquet(f"{self.root}/{table}")

    def _day(self, table: str, values: dict) -> str:
        """The folder of an entry's events: its business date, kept from its start."""
        key = values[self._KEY[table]]
        if values.get("run_dt"):
            self._opened[key] = (str(values["run_dt"]), values.get("started_at"))
        elif key not in self._opened:  # opened by another process
            row = require_single(
                self.events(table).where((F.col(self._KEY[table]) == key) & (F.col("stage") == 0)),
                f"entry {key}",
            )
            self._opened[key] = (str(row["run_dt"]), _aware(row["started_at"]))
        return self._opened[key][0]

    def events(self, table: str, run_dt: str | None = None) -> DataFrame:
        """All events, or those of one business date: only its folder is read."""
        schema = _event_schema(table)
        try:
            stored = self.spark.read.schema(
                T.StructType([*schema.fields, T.StructField("day", T.StringType())])
            ).parquet(f"{self.root}/{table}")
            if run_dt is not None:
                stored = stored.where(F.col("day") == str(run_dt))
            return stored.drop("day")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def compact(self, table: str, run_dt: str) -> None:
        """Puts the small files of a past business date together."""
        compact(self.spark, f"{self.root}/{table}", [run_dt], "day")

    def state(self, table: str, run_dt: str | None = None) -> DataFrame:
        """One row per run or table entry in the layout of the metadata table.

        A later event's value replaces an earlier one; NULL leaves it alone.
        """
        key = self._KEY[table]
        order = F.struct("stage", "at")
        columns = [c for c in METADATA_SCHEMAS[table].fieldNames() if c != key]
        return (
            self.events(table, run_dt)
            .groupBy(key)
            .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])
            .select(*METADATA_SCHEMAS[table].fieldNames())
        )

    def runs(self, run_dt: str | None = None) -> DataFrame:
        return self.state(self.MASTER, run_dt)

    def loads(self, run_dt: str | None = None) -> DataFrame:
        return self.state(self.LOG, run_dt)

    def version(self, table_id: int, process_type: str) -> int:
        """How many successful loads a table has had: its version before the next one."""
        events = self.events(self.LOG)
        mine = (F.col("table_id") == table_id) & (F.col("process_type") == process_type)
        done = events.where("stage = 2 AND status = 'SUCCESS'").select("log_id")
        return events.where("stage = 0").where(mine).join(done, "log_id", "left_semi").count()

    # ---- runs ----------------------------------------------------------
    def start_etl_run(
        self,
        pipeline_name: str,
        process_type: str,
        run_dt: str,
        trigger_type: str = "MANUAL",
        triggered_by: str = "manual",
    ) -> str:
        """Opens a run and returns its id."""
        _check(self.MASTER, process_type=process_type, trigger_type=trigger_type)
        run_id = str(uuid.uuid4())
        now = datetime.now(timezone.utc)
        self._append(
            self.MASTER, 0,
            run_id=run_id, pipeline_name=pipeline_name, process_type=process_type,
            run_dt=str(run_dt), trigger_type=trigger_type, triggered_by=triggered_by,
            status="STARTED", started_at=now, created_by=triggered_by, created_at=now,
        )
        return run_id

    def end_etl_run(self, run_id: str, error_message: str | None = None) -> str:
        """Rolls the run's table entries up, closes the run and returns its status.

        A run without any table entry is an error.  While an entry is open the
        run stays STARTED and has no end time.
        """
        run_dt = self._day(self.MASTER, {"run_id": run_id})
        # the run of an entry is in its opening event; only its date is folded
        opened = self.events(self.LOG, run_dt).where("stage = 0").where(F.col("run_id") == run_id)
        mine = self.loads(run_dt).join(opened.select("log_id"), "log_id", "left_semi")
        totals = require_single(run_rollup(mine), f"table entries of run {run_id}")
        started = self._opened[run_id][1]
        now = datetime.now(timezone.utc)
        closed = totals["status"] != "STARTED"
        self._append(
            self.MASTER, 2,
            run_id=run_id, status=totals["status"], total_tables=totals["total_tables"],
            success_count=totals["success_count"], failed_count=totals["failed_count"],
            skipped_count=totals["skipped_count"], error_message=error_message,
            finished_at=now if closed else None,
            duration_seconds=float(int((now - started).total_seconds()))
            if closed
            else None,
        )
        return totals["status"]

    # ---- table loads ---------------------------------------------------
    def log_table_start(
        self,
        run_id: str,
        table_id: int,
        table_name: str,
        process_type: str,
        load_type: str,
        run_dt: str,
        delta_version_before: int | None = None,
        triggered_by: str = "manual",
    ) -> str:
        """Opens a table entry and returns its id."""
        _check(self.LOG, process_type=process_type, load_type=load_type)
        log_id = str(uuid.uuid4())
        now = datetime.now(timezone.utc)
        self._append(
            self.LOG, 0,
            log_id=log_id, run_id=run_id, table_id=table_id, table_name=table_name,
            process_type=process_type, load_type=load_type, run_dt=str(run_dt),
            status="STARTED", delta_version_before=delta_version_before,
            started_at=now, heartbeat_at=now, created_by=triggered_by, created_at=now,
        )
        return log_id

    def heartbeat(self, log_id: str) -> None:
        """Notes that a load is still alive."""
        self._append(self.LOG, 1, log_id=log_id, heartbeat_at=datetime.now(timezone.utc))

    def log_table_end(
        self,
        log_id: str,
        status: str,
        rows_read: int | None = None,
        rows_written: int | None = None,
        delta_version_after: int | None = None,
        error_message: str | None = None,
        error_stacktrace: str | None = None,
    ) -> None:
        """Closes a table entry with its outcome and duration."""
        if status not in TERMINAL:
            raise ValueError(f"{status!r} does not close a table entry")
        self._day(self.LOG, {"log_id": log_id})
        started = self._opened[log_id][1]
        now = datetime.now(timezone.utc)
        self._append(
            self.LOG, 2,
            log_id=log_id, status=status, rows_read=rows_read, rows_written=rows_written,
            delta_version_after=delta_version_after, error_message=error_message,
            error_stacktrace=error_stacktrace, finished_at=now, heartbeat_at=now,
            duration_seconds=int((now - started).total_seconds()),
        )


def _aware(at: datetime) -> datetime:
    """Collected timestamps are naive local time; make the zone explicit."""
    return at.astimezone(timezone.utc)


