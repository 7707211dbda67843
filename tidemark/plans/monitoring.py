"""Quantiles, outages, streaks and unusual volumes; tokens; samples of exact size."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import monitoring, runs, sampling, tokens
from tidemark.plans import inputs
from tidemark.plans.inputs import table, with_sql
from tidemark.plans.registry import query
from tidemark.session import staged, work_path

WINDOW = ("2024-01-03", "2024-02-20")
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.08
SALT = "query-salt"


def _log(spark, sf_dir):
    return runs.log_state(inputs.run_events(spark, sf_dir))


@query(
    with_sql(inputs.RUN_LOG_SQL)
    + """SELECT table_id, CAST(date_trunc('year', run_dt)::DATE AS VARCHAR) AS period, count(*) AS loads,
  true AS median_in_band, true AS p95_in_band, true AS runs_in_band FROM log GROUP BY 1, 2"""
)
def sketched_durations(spark, sf_dir):
    """Yearly median, 95th percentile and distinct runs, merged from daily sketches, against exact ranks."""
    log = _log(spark, sf_dir)
    daily = monitoring.daily_sketches(log, ["table_id"], "run_dt", F.col("duration_seconds"), F.col("run_id"))
    merged = monitoring.merged_sketches(staged(daily, "daily-sketches"), "table_id", F.trunc("run_dt", "year").alias("period"))
    estimated = merged.select(
        "table_id", "period", F.col("n").alias("loads"), monitoring.distinct_keys().alias("runs"),
        *[monitoring.quantile(r).alias(c) for r, c in ((0.5, "median"), (0.95, "p95"))],
    )
    exact = log.select("table_id", F.trunc("run_dt", "year").alias("period"), "duration_seconds", "run_id")
    value = F.col("duration_seconds")
    counted = exact.join(F.broadcast(staged(estimated, "estimates")), ["table_id", "period"]).groupBy(
        "table_id", "period", "loads"
    ).agg(
        F.count(value).alias("n"), F.count_distinct("run_id").alias("exact"), F.max("runs").alias("runs"),
        *[F.count_if(value < F.col(c)).alias(f"{c}_below") for c in ("median", "p95")],
        *[F.count_if(value <= F.col(c)).alias(f"{c}_through") for c in ("median", "p95")],
    )

    def in_band(c, rank):
        return (F.col(f"{c}_below") <= (rank + RANK_ERROR) * F.col("n")) & (F.col(f"{c}_through") >= (rank - RANK_ERROR) * F.col("n"))

    return counted.select(
        "table_id", "period", "loads", in_band("median", 0.5).alias("median_in_band"), in_band("p95", 0.95).alias("p95_in_band"),
        (F.abs(F.col("runs") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")).alias("runs_in_band"),
    )


@query(
    """
SELECT l_returnflag, CAST(date_trunc('year', l_shipdate)::DATE AS VARCHAR) AS period, count(*) AS n,
  count(DISTINCT CAST(l_shipdate AS DATE)) AS days FROM lineitem GROUP BY 1, 2"""
)
def merged_daily_sketches(spark, sf_dir):
    """How many rows and days the merged sketches of a year stand for."""
    lines = table(spark, sf_dir, "lineitem").withColumn("day", inputs.day("l_shipdate"))
    daily = monitoring.daily_sketches(lines, ["l_returnflag"], "day", F.col("l_quantity"), F.col("l_partkey"))
    yearly = staged(daily, "daily-sketches").withColumn("period", F.trunc("day", "year"))
    merged = monitoring.merged_sketches(yearly, "l_returnflag", "period")
    days = yearly.groupBy("l_returnflag", "period").agg(F.count(F.lit(1)).alias("days"))
    return merged.join(days, ["l_returnflag", "period"]).select(
        "l_returnflag", "period", F.kll_sketch_get_n_bigint("amounts").alias("n"), "days"
    )


_DAYS_SQL = f"""grid AS (
  SELECT user_id AS table_id, CAST(d AS DATE) AS dt FROM (SELECT DISTINCT user_id FROM feed),
    generate_series(DATE '{WINDOW[0]}', DATE '{WINDOW[1]}', INTERVAL 1 DAY) AS s(d)),
days AS (
  SELECT g.table_id, g.dt, count(f.event_id) FILTER (WHERE event_type = 'purchase') > 0 AS ok,
    count(f.event_id) > 0 AS tried
  FROM grid g LEFT JOIN feed f ON f.user_id = g.table_id AND f.dt = g.dt GROUP BY 1, 2),
islands AS (
  SELECT *, dt - CAST(row_number() OVER (PARTITION BY table_id, ok ORDER BY dt) AS INTEGER) AS island FROM days)"""


def _daily_log(spark, sf_dir):
    """A load log from the events: a day with a purchase succeeded, any other failed."""
    return inputs.feed(spark, sf_dir).select(
        F.col("user_id").alias("table_id"), F.col("dt").alias("run_dt"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("FAILED").alias("status"),
    )


@query(
    with_sql(inputs.FEED_SQL, _DAYS_SQL)
    + f"""SELECT table_id, CAST(min(dt) AS VARCHAR) AS first_day, CAST(max(dt) AS VARCHAR) AS last_day,
  CAST(count(*) AS INTEGER) AS days, count(*) FILTER (WHERE tried) AS failed_days, max(dt) = DATE '{WINDOW[1]}' AS is_open
FROM islands WHERE NOT ok GROUP BY table_id, island"""
)
def feed_outages(spark, sf_dir):
    """Runs of days on which a feed was missing or failed."""
    log = _daily_log(spark, sf_dir)
    return monitoring.outages(log, log.select("table_id"), *WINDOW)


@query(
    with_sql(inputs.FEED_SQL, _DAYS_SQL)
    + f"""SELECT table_id, CAST(min(dt) AS VARCHAR) AS first_day, CAST(max(dt) AS VARCHAR) AS last_day,
  CAST(count(*) AS INTEGER) AS days, max(dt) = DATE '{WINDOW[1]}' AS is_open
FROM islands WHERE ok GROUP BY table_id, island"""
)
def success_streaks(spark, sf_dir):
    """Runs of days on which a feed succeeded."""
    return monitoring.streaks(_daily_log(spark, sf_dir), *WINDOW)


@query(
    f"""
WITH counts AS (
  SELECT o_orderpriority AS table_name, CAST(o_orderdate AS DATE) AS dt, count(*) AS records FROM orders GROUP BY 1, 2),
spans AS (SELECT table_name, min(dt) AS a, max(dt) AS b FROM counts GROUP BY 1),
filled AS (
  SELECT s.table_name, CAST(d AS DATE) AS dt, coalesce(c.records, 0) AS records
  FROM (SELECT table_name, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM spans) s
  LEFT JOIN counts c ON c.table_name = s.table_name AND c.dt = CAST(s.d AS DATE)),
seen AS (
  SELECT *, median(records) OVER w AS median, mad(records) OVER w AS mad, count(*) OVER w AS n FROM filled
  WINDOW w AS (PARTITION BY table_name ORDER BY dt RANGE BETWEEN INTERVAL {monitoring.TRAILING_DAYS} DAY PRECEDING
    AND INTERVAL 1 DAY PRECEDING))
SELECT table_name, CAST(dt AS VARCHAR) AS dt, records, median, mad,
  CASE WHEN mad > 0 THEN abs(records - median) / (mad * CAST({monitoring.MAD_TO_SIGMA} AS DOUBLE)) END AS deviations,
  coalesce(n >= 7 AND CASE WHEN mad > 0 THEN abs(records - median) / (mad * CAST({monitoring.MAD_TO_SIGMA} AS DOUBLE)) > 3
    ELSE abs(records - median) > 0 END, false) AS is_anomaly
FROM seen"""
)
def volume_anomalies(spark, sf_dir):
    """Daily volumes far from the median of the four weeks before."""
    counts = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("table_name"), inputs.day("o_orderdate").alias("dt")
    ).agg(F.count(F.lit(1)).alias("records"))
    return monitoring.volume_anomalies(counts)


_TOKEN_SQL = f"'{tokens.PREFIX}' || upper(substr(sha256('{SALT}' || '|' || {{0}}), 1, {tokens.DIGITS}))"


@query(
    f"""SELECT 'customer' AS loaded, c_custkey AS id, {_TOKEN_SQL.format("c_name")} AS token, c_name AS value FROM customer
UNION ALL SELECT 'orders', o_orderkey, {_TOKEN_SQL.format("c_name")}, c_name FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def tokenised_names(spark, sf_dir):
    """Names in two tables replaced by tokens from one vault, and turned back."""
    vault = work_path(spark, "vault")
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").join(names, F.col("c_custkey") == F.col("o_custkey"))
    first = names.select(F.lit("customer").alias("loaded"), F.col("c_custkey").alias("id"), F.col("c_name").alias("token"))
    second = orders.select(F.lit("orders").alias("loaded"), F.col("o_orderkey").alias("id"), F.col("c_name").alias("token"))
    hidden = []
    for load in (first.where("id % 3 = 0"), first.where("id % 3 <> 0"), second):
        tokens.register(spark, vault, load.select("token"), SALT)
        hidden.append(tokens.tokenised(load, ["token"], SALT))
    shown = staged(hidden[0].unionByName(hidden[1]).unionByName(hidden[2]), "tokenised").withColumn("value", F.col("token"))
    return tokens.restored(shown, ["value"], tokens.vault_at(spark, vault))


@query(
    with_sql(
        f"""ranked AS (
  SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY md5(concat_ws('|', '{SALT}', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS r,
    count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)"""
    )
    + "SELECT o_orderkey, o_orderpriority FROM ranked WHERE r <= floor(n * CAST(0.2 AS DOUBLE) + 0.5)"
)
def fixed_share_sample(spark, sf_dir):
    """Exactly a fifth of the orders of each priority."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.fixed_sample(orders, ["o_orderkey"], ["o_orderpriority"], SALT, share=0.2)


@query(
    f"""SELECT l_orderkey, l_linenumber, l_returnflag FROM (
  SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag
      ORDER BY md5(concat_ws('|', '{SALT}', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), l_orderkey, l_linenumber) AS r
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) WHERE r <= 500"""
)
def fixed_size_sample(spark, sf_dir):
    """Five hundred lines of each return flag."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()
    return sampling.fixed_sample(lines, ["l_orderkey", "l_linenumber"], ["l_returnflag"], SALT, size=500)
