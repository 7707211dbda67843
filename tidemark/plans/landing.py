"""Landing, Bronze loads, increments and table maintenance over the event feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.money import cents
from tidemark.loading import load_plan_rows
from tidemark.operators import defects, edits
from tidemark.operators.dedup import as_of_batch, latest_per_key
from tidemark.operators.joins import broadcast_if_small, union_all
from tidemark.operators.reports import rows_per_date
from tidemark.operators.runs import watermarks
from tidemark.plans import inputs
from tidemark.plans.inputs import sampled, table, with_sql
from tidemark.plans.registry import query
from tidemark.session import remove_folder, staged, work_path
from tidemark.sinks import catalog, tables
from tidemark.sinks.daily_feed import land_day
from tidemark.sinks.run_log import RunLog
from tidemark.sources import config, landing
from tidemark.streaming.arrivals import load_arrivals

TABLE = "events"
PRUNED_DAY, PRUNED_BATCH = "2024-01-10", 2
RUN_ID = "run-1"
COLUMNS = ["event_id", "user_id", "event_type", "value", "dt", "batch"]

_FEED = with_sql(inputs.FEED_SQL)
_COLUMNS_SQL = "event_id, user_id, event_type, value, CAST(dt AS VARCHAR) AS dt, batch"

_landed_roots: dict[tuple[str, str], str] = {}


def landed_root(spark, sf_dir):
    """The feed landed once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed_roots:
        root = work_path(spark, "landing")
        tables.land(inputs.feed(spark, sf_dir), root, TABLE)
        _landed_roots[key] = root
    return _landed_roots[key]


def _landed(spark, sf_dir):
    schema = inputs.feed(spark, sf_dir).schema
    return landing.landed(spark, landed_root(spark, sf_dir), TABLE, schema)


@query(
    _FEED
    + """SELECT CAST(dt AS VARCHAR) AS dt, count(DISTINCT batch) AS batches,
  TRUE AS has_files, TRUE AS has_bytes FROM feed GROUP BY 1"""
)
def landing_inventory(spark, sf_dir):
    """Batches and files per landed date, from a listing."""
    files = landing.inventory(spark, landed_root(spark, sf_dir), [TABLE])
    summary = landing.inventory_summary(files, "dt")
    return summary.select(
        "dt",
        "batches",
        (F.col("files") >= F.col("batches")).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query(_FEED + "SELECT CAST(dt AS VARCHAR) AS dt, max(batch) + 1 AS next_batch FROM feed GROUP BY 1")
def next_batch(spark, sf_dir):
    """The next batch number per landed date."""
    files = landing.inventory(spark, landed_root(spark, sf_dir), [TABLE])
    return landing.next_batches(files)


@query(
    _FEED
    + f"SELECT {_COLUMNS_SQL} FROM feed WHERE dt = DATE '{PRUNED_DAY}' AND batch = {PRUNED_BATCH}"
)
def partition_pruned_read(spark, sf_dir):
    """One batch of one date out of the partitioned root."""
    schema = inputs.feed(spark, sf_dir).schema
    path = landing.table_path(landed_root(spark, sf_dir), TABLE)
    df = landing.read_partitioned(spark, path, PRUNED_DAY, PRUNED_BATCH, schema)
    return df.select(*COLUMNS)


@query(
    _FEED
    + f"""SELECT CAST(dt AS VARCHAR) AS dt, batch, '{RUN_ID}' AS run_id, count(*) AS records,
  count(*) AS traced FROM feed GROUP BY 1, 2"""
)
def lineage_stamped(spark, sf_dir):
    """Rows whose source file is the folder they belong to."""
    stamped = landing.stamp_lineage(_landed(spark, sf_dir), RUN_ID)
    folder = F.concat(
        F.lit("/dt="), F.col("dt").cast("string"), F.lit("/batch="), F.col("batch").cast("string"),
        F.lit("/"),
    )
    return stamped.groupBy("dt", "batch", F.col(landing.RUN_ID).alias("run_id")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.contains(F.col(landing.SOURCE_FILE), folder)).alias("traced"),
    )


@query(_FEED + f"SELECT {_COLUMNS_SQL}, '{RUN_ID}' AS run_id FROM feed")
def bronze_idempotent(spark, sf_dir):
    """Bronze after the same load ran twice."""
    target = work_path(spark, "bronze")
    for _ in range(2):
        tables.load_bronze(landing.stamp_lineage(_landed(spark, sf_dir), RUN_ID), target)
    # a third, narrower load replaces its own date only
    day = landing.rows_since(_landed(spark, sf_dir), "dt", "2024-01-29").where("dt = '2024-01-30'")
    where = tables.replace_predicate("dt = '{run_dt}'", "2024-01-30")
    tables.load_bronze(landing.stamp_lineage(day, RUN_ID), target, replace_where=where)
    bronze = spark.read.parquet(target)
    return bronze.select(*COLUMNS, F.col(landing.RUN_ID).alias("run_id"))


@query(
    _FEED
    + """SELECT f.event_id, f.event_type, CAST(f.dt AS VARCHAR) AS dt FROM feed f
LEFT JOIN (SELECT event_type, max(dt) AS watermark FROM feed
  WHERE value > 480 GROUP BY event_type) w USING (event_type)
WHERE watermark IS NULL OR f.dt > watermark"""
)
def incremental_since_watermark(spark, sf_dir):
    """Events after the last successful date of their feed; a value over 480 marks a success."""
    log = table(spark, sf_dir, "events").select(
        "event_type",
        inputs.day("ts").alias("run_dt"),
        F.when(F.col("value") > 480, "SUCCESS").otherwise("FAILED").alias("status"),
    )
    stored = staged(watermarks(log, "event_type"), "watermarks")
    feeds = _landed(spark, sf_dir).select("event_type").distinct()
    # one date: nothing before the least watermark can be new, if every feed has one
    open_feeds = feeds.join(stored, "event_type", "left_anti").limit(1).count()
    least = None if open_feeds else stored.agg(F.min("watermark")).first()[0]
    candidates = landing.rows_since(_landed(spark, sf_dir), "dt", least)
    joined = candidates.join(broadcast_if_small(stored), "event_type", "left")
    fresh = joined.where(F.col("watermark").isNull() | (F.col("dt") > F.col("watermark")))
    return fresh.select("event_id", "event_type", "dt")


_KEY = ["dt", "user_id", "event_type"]


@query(
    _FEED
    + f"""SELECT {_COLUMNS_SQL} FROM (SELECT *, row_number() OVER (
    PARTITION BY dt, user_id, event_type ORDER BY batch DESC, ts DESC) AS r FROM feed)
WHERE r = 1"""
)
def upsert_latest(spark, sf_dir):
    """Morning rows with the afternoon's rows put in by key, date by date."""
    target = work_path(spark, "upserted")
    newest = latest_per_key(_landed(spark, sf_dir), [*_KEY, "batch"], ["ts"])
    tables.full_refresh(newest.where("batch = 1"), target, ["dt"])
    tables.upsert_partitions(spark, newest.where("batch = 2"), target, _KEY)
    return spark.read.parquet(target).select(*COLUMNS)


@query(
    _FEED
    + f"""SELECT {_COLUMNS_SQL} FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM feed WHERE batch <= 1)
WHERE r = 1"""
)
def as_of_first_batch(spark, sf_dir):
    """The newest row per user as it stood before the second batch."""
    snapshot = as_of_batch(
        _landed(spark, sf_dir), ["user_id"], batch=1, newest_first=["ts", "event_id"]
    )
    return snapshot.select(*COLUMNS)


@query(_FEED + f"SELECT {_COLUMNS_SQL} FROM feed WHERE batch = 2")
def full_refresh(spark, sf_dir):
    """A table loaded, then replaced as a whole."""
    target = work_path(spark, "refreshed")
    feed = _landed(spark, sf_dir)
    tables.full_refresh(feed.where("batch = 1"), target)
    tables.full_refresh(feed.where("batch = 2"), target)
    return spark.read.schema(feed.schema).parquet(target).select(*COLUMNS)


@query(
    _FEED
    + """SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS records,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM feed GROUP BY 1"""
)
def appended_batches(spark, sf_dir):
    """Both batches appended one after the other."""
    target = work_path(spark, "appended")
    feed = _landed(spark, sf_dir)
    for batch in (1, 2):
        tables.append(feed.where(F.col("batch") == batch), target, ["dt"])
    stored = spark.read.parquet(target)
    return stored.groupBy("dt").agg(
        F.count(F.lit(1)).alias("records"), F.sum(cents(F.col("value"))).alias("value_cents")
    )


@query(
    """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'SUCCESS' ELSE o_orderstatus END
  AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END
  AS o_totalprice FROM orders"""
)
def updated_rows(spark, sf_dir):
    """Orders after an UPDATE whose expressions use the old values."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    return edits.updated(
        orders,
        F.col("o_orderstatus") == "P",
        {"o_orderstatus": F.lit("SUCCESS"), "o_totalprice": F.col("o_totalprice") * 2},
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
WHERE NOT (l_returnflag = 'R' AND l_linenumber IN (1, 3))"""
)
def deleted_rows(spark, sf_dir):
    """Lineitems after a DELETE with AND and IN."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )
    gone = (F.col("l_returnflag") == "R") & F.col("l_linenumber").isin(1, 3)
    return edits.without(lines, gone)


@query(
    _FEED
    + f"""SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS records FROM feed
WHERE dt <> DATE '{PRUNED_DAY}' GROUP BY 1"""
)
def dropped_partition(spark, sf_dir):
    """Rows per date of a catalog table after one date was dropped."""
    name, path = f"feed_{uuid.uuid4().hex}", work_path(spark, "catalog")
    (
        tables.sized(_landed(spark, sf_dir), "dt")
        .write.partitionBy("dt")
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    catalog.drop_partitions(spark, [name], PRUNED_DAY)
    left = staged(rows_per_date(spark.table(name), name).drop("table_name"), "dropped-partition")
    spark.sql(f"DROP TABLE {name}")
    remove_folder(spark, path)
    return left


@query(
    _FEED
    + "SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS records, TRUE AS fewer_files FROM feed GROUP BY 1"
)
def compacted_feed(spark, sf_dir):
    """Dates of a table written in many small files, before and after compaction."""
    root = work_path(spark, "small-files")
    path = landing.table_path(root, TABLE)
    feed = _landed(spark, sf_dir)
    feed.repartition(8).write.partitionBy("dt").parquet(path)
    before = _files_per_day(spark, path).withColumnRenamed("files", "files_before")
    before.write.parquet(f"{root}/files_before")
    days = [d.isoformat() for d in tables.touched_dates(spark.read.parquet(path))]
    tables.compact(spark, path, days)
    counts = rows_per_date(spark.read.parquet(path), TABLE)
    return (
        counts.join(spark.read.parquet(f"{root}/files_before"), "dt")
        .join(_files_per_day(spark, path), "dt")
        .select("dt", "records", (F.col("files") < F.col("files_before")).alias("fewer_files"))
    )


def _files_per_day(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy("dt").agg(F.count(F.lit(1)).alias("files"))


@query(
    _FEED + "SELECT CAST(dt AS VARCHAR) AS dt, batch, count(*) AS records FROM feed GROUP BY 1, 2"
)
def stream_arrivals(spark, sf_dir):
    """Bronze kept current by a stream over two deliveries."""
    root, target = work_path(spark, "arriving"), work_path(spark, "streamed")
    checkpoint = work_path(spark, "offsets")
    feed = inputs.feed(spark, sf_dir)
    for batch in (1, 2):
        tables.land(feed.where(F.col("batch") == batch), root, TABLE)
        load_arrivals(spark, root, TABLE, feed.schema, target, checkpoint, f"run-{batch}")
    bronze = spark.read.parquet(target)
    return bronze.groupBy("dt", "batch").agg(F.count(F.lit(1)).alias("records"))


@query(
    _FEED
    + "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS source_format, CAST(dt AS VARCHAR) AS dt, count(*) AS records,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM feed GROUP BY 2"""
        for name in ("PARQUET", "CSV", "JSON")
    )
)
def source_formats(spark, sf_dir):
    """The feed written and read back in every configured format."""
    feed = inputs.feed(spark, sf_dir).select(*COLUMNS)
    parts = []
    for name in ("PARQUET", "CSV", "JSON"):
        path = work_path(spark, name.lower())
        feed.write.format(landing.FORMATS[name]).save(path)
        stored = landing.read_source(spark, name, path, feed.schema)
        parts.append(
            stored.groupBy("dt").agg(
                F.lit(name).alias("source_format"),
                F.count(F.lit(1)).alias("records"),
                F.sum(cents(F.col("value"))).alias("value_cents"),
            )
        )
    return union_all(parts)


FIRST_DATE, SECOND_DATE = "2024-01-15", "2024-02-15"


def _day_sql(run_dt: str) -> list[str]:
    ids = f"""ids AS (SELECT c_custkey + 1 AS id, DATE '{run_dt}' AS dt FROM customer)"""
    return [ids, *inputs.loans_sql()[1:], inputs.INSTALLMENTS_SQL]


_REPAID = sampled(0.8, "repay", '"LoanID"', '"InstallmentNo"')
_TWICE = sampled(defects.DUPLICATE_RATE, "duplicate", '"LoanID"')
_DAY_COUNTS = f"""SELECT 't_Client' AS table_name, count(*) AS records FROM ids
UNION ALL SELECT 't_AccountCustomer', count(*) FROM accounts
UNION ALL SELECT 't_Loan', count(*) + count(*) FILTER (WHERE {_TWICE}) FROM loans
UNION ALL SELECT 't_LoanInstallment', count(*) FROM installments"""


@query(
    f"""SELECT '{FIRST_DATE}' AS dt, * FROM ({with_sql(*_day_sql(FIRST_DATE))} {_DAY_COUNTS}
  UNION ALL SELECT 't_AccountTrx', count(*) FROM loans)
UNION ALL
SELECT '{SECOND_DATE}', * FROM ({with_sql(*_day_sql(FIRST_DATE))} {_DAY_COUNTS}
  UNION ALL SELECT 't_AccountTrx', count(*) + (SELECT count(*) FROM installments
    WHERE "InstallmentDate" = DATE '{SECOND_DATE}' AND {_REPAID}) FROM loans)"""
)
def daily_landing(spark, sf_dir):
    """Two business dates of the five-table feed; the second repays the first."""
    root = work_path(spark, "days")
    numbers = inputs.client_ids(spark, sf_dir).select("id")
    for run_dt in (FIRST_DATE, SECOND_DATE):
        land_day(numbers, root, run_dt, inputs.TODAY)
    names = ["t_Client", "t_AccountCustomer", "t_Loan", "t_LoanInstallment", "t_AccountTrx"]
    return union_all([rows_per_date(landing.landed(spark, root, n), n) for n in names])


_LOADED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "customer": None}


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, 'SUCCESS' AS status, count(*) AS rows_read,
  count(*) AS rows_written FROM {name}"""
        for name in _LOADED
    )
    + "\nUNION ALL SELECT 'absent', 'SKIPPED', 0, 0"
)
def audited_load(spark, sf_dir):
    """Whole tables loaded from configuration rows, as the run log saw it."""
    root, target = work_path(spark, "sources"), work_path(spark, "targets")
    log = RunLog(spark, work_path(spark, "run-log"))
    for name in _LOADED:
        table(spark, sf_dir, name).write.parquet(f"{root}/{name}")
    priorities = {name: n for n, name in enumerate([*_LOADED, "absent"], start=1)}
    registry = (
        config.table_config(spark, root, priorities=priorities)
        .withColumn("source_path_pattern", F.concat(F.lit(f"{root}/"), "source_table_name"))
        .withColumn("partition_cols", F.lit(None).cast("string"))
    )
    layers = config.process_config(registry, list(priorities)).withColumn(
        "load_type", F.lit("FULL")
    )
    load_plan_rows(spark, log, registry, layers, FIRST_DATE, target)
    return log.loads().select("table_name", "status", "rows_read", "rows_written")
