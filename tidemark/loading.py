"""Audited, configuration-driven loads: landing to Bronze, Bronze to Silver."""

from __future__ import annotations

import traceback
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import drift
from tidemark.operators.runs import upstream_ready
from tidemark.operators.silver import checked, column_rules, rejected, silver, transform_for
from tidemark.schemas import ColumnRule, natural_key
from tidemark.sinks.run_log import RunLog
from tidemark.sinks.tables import append, full_refresh, load_bronze, replace_predicate
from tidemark.sources.config import get_input_column_config
from tidemark.sources.landing import (
    INGESTED_AT,
    NO_SOURCE,
    RUN_ID,
    SOURCE_FILE,
    has_rows,
    read_partitioned,
    read_source,
    resolve_path,
    stamp_lineage,
    table_schema,
)

_LINEAGE = (RUN_ID, INGESTED_AT, SOURCE_FILE)


def _schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The business columns a target table has, or None if it does not exist yet."""
    known = table_schema(spark, path)
    return known and T.StructType([f for f in known.fields if f.name not in _LINEAGE])


def _typed(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Text columns of a CSV or JSON source in the types the column rules give them.

    Columns are found by name and none is dropped; a value that does not fit its type
    fails the load.  Columns without a rule stay text.
    """
    kinds = {r.source.lower(): r.data_type for r in rules if r.active and r.purpose != "DERIVED"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(kinds[f.name.lower()]).alias(f.name)
            if f.name.lower() in kinds and isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _source(
    spark: SparkSession, table: Mapping[str, Any], run_dt: str, rules: Sequence[ColumnRule] = ()
) -> DataFrame | None:
    """The rows landed for a date, or None if there are none."""
    path = resolve_path(table["source_path_pattern"], table["source_table_name"], run_dt)
    base = path.split("/dt=")[0]
    try:
        # header matters to CSV only, primitivesAsString to JSON
        df = read_source(
            spark, table["source_format"], path, basePath=base, header="true",
            primitivesAsString=str(bool(rules)).lower(),
        )
    except AnalysisException as error:
        if error.getCondition() in NO_SOURCE:
            return None
        raise
    return df if has_rows(df) else None


def _park(spark: SparkSession, rows: DataFrame, path: str, run_dt: str) -> None:
    """Quarantined rows by business date: a repeated load parks the same rows again."""
    dated = rows.withColumn("run_dt", F.lit(run_dt).cast("date"))
    load_bronze(dated, path, ["run_dt"], f"run_dt = DATE '{run_dt}'")


def load_table(
    spark: SparkSession,
    log: RunLog,
    run_id: str,
    table: Mapping[str, Any],
    layer: Mapping[str, Any],
    run_dt: str,
    target_root: str,
    rules: Sequence[ColumnRule] = (),
) -> str:
    """Loads one configured table for a business date and returns the outcome.

    FULL replaces the table, INCREMENTAL the rows of ``replace_where_template``.
    SKIPPED: nothing landed.  QUARANTINED: the layout drifted and the policy
    parks such rows, in ``<table>_quarantine`` by ``run_dt``.  FAILED: the error is in
    the log and the target is as it was.  ``rules`` give CSV and JSON sources their
    types.  The log's versions are how many successful loads the table had.
    """
    target = f"{target_root.rstrip('/')}/{table['target_table']}"
    log_id = log.log_table_start(
        run_id, table["table_id"], table["source_table_name"], layer["process_type"],
        layer["load_type"], run_dt, version := log.version(table["table_id"], layer["process_type"]),
    )
    try:
        source = _source(spark, table, run_dt, rules)
        if source is None:
            log.log_table_end(log_id, "SKIPPED", 0, 0)
            return "SKIPPED"
        rows_read = source.count()
        parts = [c.strip() for c in (table["partition_cols"] or "").split(",") if c.strip()]
        known = _schema_of(spark, target)
        stamped = _typed(stamp_lineage(source, run_id), rules)
        lineage = list(_LINEAGE)
        if known is not None:
            layout = T.StructType([*known.fields, *stamped.schema.fields[-3:]])
            outcome = drift.apply_policy(stamped, layout, table["drift_policy"])
            _log_drift(spark, log, run_id, table, outcome.findings)
            if outcome.accepted is None:
                _park(spark, outcome.quarantined, f"{target}_quarantine", run_dt)
                log.log_table_end(log_id, "QUARANTINED", rows_read, 0)
                return "QUARANTINED"
            stamped = outcome.accepted
        hook = transform_for(layer["transform_module"])
        frame = stamped.transform(hook) if hook else stamped
        frame = frame.select(*[c for c in frame.columns if c not in lineage], *lineage)
        if layer["load_type"] == "FULL":
            full_refresh(frame, target, parts)
            written = spark.read.schema(frame.schema).parquet(target)
        else:
            where = replace_predicate(table["replace_where_template"], run_dt)
            load_bronze(frame, target, parts, where)
            written = spark.read.schema(frame.schema).parquet(target).where(F.expr(where))
        log.log_table_end(log_id, "SUCCESS", rows_read, written.count(), version + 1)
        return "SUCCESS"
    except Exception as error:  # noqa: BLE001 - the outcome goes to the log
        if isinstance(error, drift.SchemaDrift):
            _log_drift(spark, log, run_id, table, error.findings)
        log.log_table_end(
            log_id, "FAILED", error_message=str(error),
            error_stacktrace=traceback.format_exc(),
        )
        return "FAILED"


def build_silver(
    spark: SparkSession,
    log: RunLog,
    run_id: str,
    table: Mapping[str, Any],
    layer: Mapping[str, Any],
    rules: Sequence[ColumnRule],
    key: Sequence[str],
    run_dt: str,
    bronze_root: str,
    silver_root: str,
    *,
    salt: str,
    newest_first: Sequence[str] = ("LastUpdatedAt", "batch"),
) -> str:
    """Builds a Silver table from Bronze by its column rules and returns the outcome.

    INCREMENTAL takes one date and replaces that date, FULL takes and replaces
    everything.  Accepted rows are reduced to the newest per key; rejected rows
    go to ``<table>_rejects`` with their reasons.  Personal columns need a ``salt``.
    """
    name = table["target_table"]
    log_id = log.log_table_start(
        run_id, table["table_id"], table["source_table_name"], "SILVER", layer["load_type"], run_dt,
        version := log.version(table["table_id"], "SILVER"),
    )
    try:
        if not salt and any(r.pii and r.active for r in rules):
            raise ValueError(f"{name} has personal columns; masking them needs a salt")
        full = layer["load_type"] == "FULL"
        bronze = read_partitioned(spark, f"{bronze_root}/{name}", None if full else run_dt)
        if not has_rows(bronze):
            log.log_table_end(log_id, "SKIPPED", 0, 0)
            return "SKIPPED"
        hook = transform_for(layer["transform_module"])
        source = bronze.transform(hook) if hook else bronze
        write = full_refresh if full else load_bronze
        target = f"{silver_root}/{name}"
        where = {} if full else {"replace_where": f"dt = DATE '{run_dt}'"}
        good = silver(source, rules, key, newest_first, salt, rare_duplicates=True)
        write(good, target, ["dt"], **where)
        write(rejected(checked(source, rules, salt)), f"{target}_rejects", ["dt"], **where)
        written = read_partitioned(spark, target, None if full else run_dt).count()
        log.log_table_end(log_id, "SUCCESS", bronze.count(), written, version + 1)
        return "SUCCESS"
    except Exception as error:  # noqa: BLE001 - the outcome goes to the log
        log.log_table_end(
            log_id, "FAILED", error_message=str(error),
            error_stacktrace=traceback.format_exc(),
        )
        return "FAILED"


def _log_drift(spark, log: RunLog, run_id: str, table: Mapping[str, Any], findings) -> None:
    if findings:
        now = spark.sql("SELECT cast(current_timestamp() AS string)").first()[0]
        rows = drift.drift_log_rows(
            spark, findings, run_id, table["table_id"], table["drift_policy"], now
        )
        append(rows.coalesce(1), f"{log.root}/schema_drift_log")


def _blocked(
    spark: SparkSession, log: RunLog, layer: Mapping[str, Any], run_dt: str
) -> str | None:
    """Why a table has to wait, or None: an upstream has no success for the date."""
    if not layer["depends_on_table_ids"]:
        return None
    needs = spark.createDataFrame(
        [(layer["table_id"], layer["process_type"], layer["depends_on_table_ids"])],
        "table_id bigint, process_type string, depends_on_table_ids string",
    )
    found = upstream_ready(needs, log.loads(run_dt), run_dt).first()
    if found["is_ready"]:
        return None
    return (
        f"{found['ready_upstreams']} of {found['upstreams']} upstream tables "
        f"({layer['depends_on_table_ids']}) are loaded for {run_dt}"
    )


def load_plan_rows(
    spark: SparkSession,
    log: RunLog,
    tables: DataFrame,
    layers: DataFrame,
    run_dt: str,
    target_root: str,
    process_type: str = "BRONZE",
    pipeline_name: str = "load",
    trigger_type: str = "MANUAL",
    columns: DataFrame | None = None,
    bronze_root: str | None = None,
    salt: str = "",
    keys: Mapping[str, Sequence[str]] | None = None,
    newest_first: Sequence[str] = ("LastUpdatedAt", "batch"),
) -> str:
    """Loads all active tables of a layer in priority order as one run; returns its status.

    A table whose upstreams have no success for the date is SKIPPED with the reason.
    SILVER reads ``bronze_root`` by the column configuration ``columns``; for BRONZE those
    give CSV and JSON sources their types.  ``keys`` are the natural keys by table name,
    the declared ones if left out.  One plan row is fetched per configured table; the
    data stays on the cluster.
    """
    if process_type == "SILVER" and (columns is None or bronze_root is None):
        raise ValueError("a SILVER load needs the column configuration and the Bronze root")
    active = layers.where(F.col("is_active") & (F.col("process_type") == process_type))
    wanted = (
        active.select(
            "table_id", "process_type", "load_type", "depends_on_table_ids", "transform_module"
        )
        .join(tables.where("is_active").drop("is_active"), "table_id")
        .orderBy("load_priority", "table_id")
        .collect()
    )
    run_id = log.start_etl_run(pipeline_name, process_type, run_dt, trigger_type)
    for row in wanted:
        config = row.asDict()
        name = config["source_table_name"]
        if reason := _blocked(spark, log, config, run_dt):
            log_id = log.log_table_start(
                run_id, config["table_id"], name, process_type, config["load_type"], run_dt
            )
            log.log_table_end(log_id, "SKIPPED", 0, 0, error_message=reason)
            continue
        rules: Sequence[ColumnRule] = ()
        if columns is not None and (process_type == "SILVER" or config["source_format"] in ("CSV", "JSON")):
            rules = column_rules(get_input_column_config(tables, columns, name))
        if process_type == "SILVER":
            key = (keys or {}).get(name) or natural_key(name)
            build_silver(
                spark, log, run_id, config, config, rules, key, run_dt, bronze_root, target_root,
                salt=salt, newest_first=newest_first,
            )
        else:
            load_table(spark, log, run_id, config, config, run_dt, target_root, rules)
    return log.end_etl_run(run_id)
