"""Repeated loads, edits and configured loads that must keep all rows and columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.loading import load_plan_rows
from tidemark.operators.dedup import latest_per_key
from tidemark.plans import inputs
from tidemark.plans.inputs import table, with_sql
from tidemark.plans.registry import query
from tidemark.schemas import ColumnRule
from tidemark.session import work_path
from tidemark.sinks import tables
from tidemark.sinks.run_log import RunLog
from tidemark.sources import config, landing

MIDDLE, ONE_DAY = "2024-01-16", "2024-01-10"
FIRST, SECOND = "2024-03-01", "2024-03-02"
SALT = "query-salt"
COLUMNS = ["event_id", "user_id", "event_type", "value", "dt", "batch"]

_FEED = with_sql(inputs.FEED_SQL)
_COLUMNS_SQL = "event_id, user_id, event_type, value, CAST(dt AS VARCHAR) AS dt, batch"


def _feed(spark, sf_dir):
    return inputs.feed(spark, sf_dir).select(*COLUMNS)


@query(_FEED + f"SELECT {_COLUMNS_SQL} FROM feed")
def incremental_two_halves(spark, sf_dir):
    """A table without partitions, loaded by predicate in two halves, the first one twice."""
    target = work_path(spark, "halves")
    feed = _feed(spark, sf_dir)
    for where in (f"dt < DATE '{MIDDLE}'", f"dt >= DATE '{MIDDLE}'", f"dt < DATE '{MIDDLE}'"):
        tables.load_bronze(feed.where(where), target, (), where)
    return landing.read_partitioned(spark, target).select(*COLUMNS)


@query(
    _FEED
    + f"SELECT {_COLUMNS_SQL} FROM feed WHERE NOT (dt = DATE '{ONE_DAY}' AND batch = 2)"
)
def replaced_date(spark, sf_dir):
    """A date loaded again without its second batch, which must not stay behind."""
    target = work_path(spark, "replaced-date")
    feed = _feed(spark, sf_dir)
    tables.load_bronze(feed, target, ["dt", "batch"])
    again = feed.where(f"dt = DATE '{ONE_DAY}' AND batch = 1")
    tables.load_bronze(again, target, ["dt", "batch"], f"dt = DATE '{ONE_DAY}'")
    return landing.read_partitioned(spark, target).select(*COLUMNS)


@query(
    _FEED
    + f"""SELECT event_id, user_id, event_type, CASE WHEN dt >= DATE '{MIDDLE}' THEN value END AS value,
  CAST(dt AS VARCHAR) AS dt, batch FROM feed"""
)
def compacted_after_evolve(spark, sf_dir):
    """A column that came half-way through, after all dates were compacted."""
    target = work_path(spark, "evolved")
    feed = _feed(spark, sf_dir).repartition(8)
    tables.append(feed.drop("value").where(f"dt < DATE '{MIDDLE}'"), target, ["dt"])
    tables.append(feed.where(f"dt >= DATE '{MIDDLE}'"), target, ["dt"])
    days = [d.isoformat() for d in tables.touched_dates(landing.read_partitioned(spark, target))]
    tables.compact(spark, target, days)
    return landing.read_partitioned(spark, target).select(*COLUMNS)


_KEY = ["dt", "user_id", "event_type"]


@query(
    _FEED
    + f"""SELECT event_id, user_id, event_type, CASE WHEN batch = 2 THEN value END AS value,
  CAST(dt AS VARCHAR) AS dt, batch FROM (SELECT *, row_number() OVER (
    PARTITION BY dt, user_id, event_type ORDER BY batch DESC, ts DESC) AS r FROM feed)
WHERE r = 1"""
)
def upsert_wider(spark, sf_dir):
    """Morning rows without a value, with the afternoon's rows, which have one, put in."""
    target = work_path(spark, "wider")
    newest = latest_per_key(inputs.feed(spark, sf_dir), [*_KEY, "batch"], ["ts"]).select(*COLUMNS)
    tables.full_refresh(newest.where("batch = 1").drop("value"), target, ["dt"])
    tables.upsert_partitions(spark, newest.where("batch = 2"), target, _KEY)
    return landing.read_partitioned(spark, target).select(*COLUMNS)


@query(_FEED + f"SELECT {_COLUMNS_SQL} FROM feed WHERE dt <> DATE '{ONE_DAY}'")
def deleted_date(spark, sf_dir):
    """A table after every row of one date was deleted."""
    target = work_path(spark, "deleted")
    tables.full_refresh(_feed(spark, sf_dir), target, ["dt"])
    tables.rewrite_partitions(spark, target, [ONE_DAY], lambda df: df.where("false"))
    return landing.read_partitioned(spark, target).select(*COLUMNS)


def _registry(spark, root, names, **columns):
    """Configuration of the named tables, with some columns set alike for all of them."""
    registry = config.table_config(spark, root, priorities=dict(zip(names, range(1, len(names) + 1))))
    return registry.withColumns({k: F.lit(v) for k, v in columns.items()})


def _land(df, root, name, run_dt, fmt="parquet"):
    df.write.format(fmt).option("header", "true").save(f"{root}/{name}/dt={run_dt}/batch=1")


@query(
    _FEED
    + f"""SELECT '{SECOND}' AS run_dt, count(*) AS parked,
  count(*) FILTER (WHERE value > 480) AS with_null FROM feed"""
)
def quarantine_rerun(spark, sf_dir):
    """A drifted date parked by two runs of the same load, absent values and all."""
    root, target = work_path(spark, "drifting"), work_path(spark, "bronze")
    log = RunLog(spark, work_path(spark, "run-log"))
    feed = inputs.feed(spark, sf_dir).drop("dt", "batch")
    _land(feed.drop("value"), root, "events", FIRST)
    _land(feed.withColumn("value", F.expr("CASE WHEN value <= 480 THEN value END")), root, "events", SECOND)
    registry = _registry(spark, root, ["events"], drift_policy="QUARANTINE")
    layers = config.process_config(registry, ["events"])
    for run_dt in (FIRST, SECOND, SECOND):
        load_plan_rows(spark, log, registry, layers, run_dt, target)
    parked = landing.read_partitioned(spark, f"{target}/events_quarantine")
    return parked.groupBy("run_dt").agg(
        F.count(F.lit(1)).alias("parked"),
        F.count_if(F.contains("payload", F.lit('"value":null'))).alias("with_null"),
    )


_EVENT_RULES = {
    "events": [
        ColumnRule("event_id", "event_id", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("user_id", "user_id", "BIGINT"),
        ColumnRule("event_type", "event_type", "STRING"),
        ColumnRule("value", "value", "DOUBLE", purpose="MEASURE"),
    ]
}


@query(
    _FEED
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS source_format, event_id, user_id, event_type, value, event_id + 1 AS next_id FROM feed"
        for name in ("CSV", "JSON")
    )
)
def typed_text_loads(spark, sf_dir):
    """Text sources loaded in the types that the column configuration declares."""
    parts = []
    feed = inputs.feed(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    for name in ("CSV", "JSON"):
        root, target = work_path(spark, name.lower()), work_path(spark, "typed")
        log = RunLog(spark, work_path(spark, "run-log"))
        _land(feed, root, "events", FIRST, name.lower())
        registry = _registry(spark, root, ["events"], source_format=name)
        columns = config.column_config(registry, config.rule_rows(spark, _EVENT_RULES))
        layers = config.process_config(registry, ["events"])
        load_plan_rows(spark, log, registry, layers, FIRST, target, columns=columns)
        stored = landing.read_partitioned(spark, f"{target}/events")
        parts.append(
            stored.select(
                F.lit(name).alias("source_format"), "event_id", "user_id", "event_type", "value",
                (F.col("event_id") + 1).alias("next_id"),
            )
        )
    return parts[0].unionByName(parts[1])


_SILVER_TABLES = {
    "customer": [
        ColumnRule("c_custkey", "c_custkey", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("c_name", "c_name", "STRING", pii=True),
        ColumnRule("c_acctbal", "c_acctbal", "DOUBLE", purpose="MEASURE"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
    "orders": [
        ColumnRule("o_orderkey", "o_orderkey", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("o_custkey", "o_custkey", "BIGINT", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
}
_SILVER_TABLES["waiting"] = _SILVER_TABLES["orders"]
_SILVER_KEYS = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "waiting": ["o_orderkey"]}


def _configured_silver(spark, sf_dir):
    """Customers in two batches and orders through Bronze and Silver; one table waits in vain."""
    root, bronze, target = (work_path(spark, n) for n in ("sources", "bronze", "silver"))
    log = RunLog(spark, work_path(spark, "run-log"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    _land(customers, root, "customer", FIRST)
    later = customers.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    later.write.parquet(f"{root}/customer/dt={FIRST}/batch=2")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    _land(orders, root, "orders", FIRST)
    _land(orders, root, "waiting", FIRST)
    names = [*_SILVER_TABLES, "absent"]
    registry = _registry(spark, root, names)
    columns = config.column_config(registry, config.rule_rows(spark, _SILVER_TABLES))
    bronze_layers = config.process_config(registry, names)
    load_plan_rows(spark, log, registry, bronze_layers, FIRST, bronze)
    needs = F.expr("CASE table_id WHEN 2 THEN '1' WHEN 3 THEN '1,4' END")
    layers = config.process_config(registry, list(_SILVER_TABLES), "SILVER").withColumn(
        "depends_on_table_ids", needs
    )
    load_plan_rows(
        spark, log, registry, layers, FIRST, target, "SILVER", columns=columns, bronze_root=bronze,
        salt=SALT, keys=_SILVER_KEYS, newest_first=("batch",),
    )
    return log, target


@query(
    f"""SELECT c_custkey, sha256('{SALT}' || c_name) AS c_name,
  CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS batch FROM customer"""
)
def configured_silver(spark, sf_dir):
    """Silver customers of a configured load: masked, typed, the newest of each."""
    _, target = _configured_silver(spark, sf_dir)
    stored = landing.read_partitioned(spark, f"{target}/customer")
    return stored.select("c_custkey", "c_name", "c_acctbal", "batch")


@query(
    """
SELECT 'BRONZE' AS process_type, 'customer' AS table_name, 'SUCCESS' AS status,
  count(*) + count(*) FILTER (WHERE c_custkey % 2 = 0) AS rows_read,
  count(*) + count(*) FILTER (WHERE c_custkey % 2 = 0) AS rows_written,
  CAST(1 AS BIGINT) AS version FROM customer
UNION ALL SELECT 'BRONZE', 'orders', 'SUCCESS', count(*), count(*), 1 FROM orders
UNION ALL SELECT 'BRONZE', 'waiting', 'SUCCESS', count(*), count(*), 1 FROM orders
UNION ALL SELECT 'BRONZE', 'absent', 'SKIPPED', 0, 0, NULL
UNION ALL SELECT 'SILVER', 'customer', 'SUCCESS',
  count(*) + count(*) FILTER (WHERE c_custkey % 2 = 0), count(*), 1 FROM customer
UNION ALL SELECT 'SILVER', 'orders', 'SUCCESS', count(*), count(*), 1 FROM orders
UNION ALL SELECT 'SILVER', 'waiting', 'SKIPPED', 0, 0, NULL"""
)
def configured_silver_log(spark, sf_dir):
    """The same load as the run log saw it: a table waits while an upstream is missing."""
    log, _ = _configured_silver(spark, sf_dir)
    return log.loads().select(
        "process_type", "table_name", "status", "rows_read", "rows_written",
        F.col("delta_version_after").alias("version"),
    )
