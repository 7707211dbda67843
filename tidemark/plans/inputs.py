"""The supplied tables seen as lending feeds, and the same views as SQL text.

* a client per customer, with accounts, loans and schedule fanned out from it
* a loan per order, with the order's lineitems as its payments
* a dated and batched landing feed from the events
* a run log from orders (start and end of a load) and lineitems (signs of life)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_cut, in_hash_sample
from tidemark.functions.money import cents
from tidemark.functions.terms import FEED_INSTALLMENTS, FIRST_NAMES, LAST_NAMES, STATES
from tidemark.operators import lending

TODAY = "2024-03-01"
FIRST_DAY = "2024-02-01"
DAYS = 29
OPEN_RATE = 0.05
#: How many rows a task may produce of those it was given.
ROWS_PER_TASK = 4_000_000
#: Up to two accounts of a client, two loans of an account, and their installments.
ROWS_OF_CLIENT = 2 * 2 * FEED_INSTALLMENTS
STATUS_OF_ORDER = {"F": "SUCCESS", "O": "FAILED", "P": "SKIPPED"}



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, fan_out: Column | int) -> DataFrame:
    """Rows over all cores, and over as many tasks as what they fan out to needs.

    For plans that multiply every row many times, ``fan_out`` being the rows made of each:
    the splits of a scan follow the bytes read, which say nothing of the rows that a task is
    to produce.  No task gets more than about ``ROWS_PER_TASK`` of those, however large the
    input.  Costs one scan of the columns that ``fan_out`` names.
    """
    fan_out = F.lit(fan_out) if isinstance(fan_out, int) else fan_out
    produced = df.agg(F.sum(fan_out.cast("bigint"))).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-produced // ROWS_PER_TASK))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def day(column: str) -> Column:
    return F.col(column).cast("date")


def client_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, dt``: customers numbered from one, spread over a month of business dates."""
    number = (F.col("c_custkey") + 1).alias("id")
    dates = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("id") % DAYS).cast("int"))
    return table(spark, sf_dir, "customer").select(number).withColumn("dt", dates)


def accounts_of_clients(spark: SparkSession, sf_dir: str, seq_width: int = 4) -> DataFrame:
    return lending.accounts(spread(client_ids(spark, sf_dir), ROWS_OF_CLIENT), seq_width=seq_width)


def loans_of_clients(spark: SparkSession, sf_dir: str, seq_width: int = 4) -> DataFrame:
    return lending.loans(accounts_of_clients(spark, sf_dir, seq_width))


def order_loans(
    spark: SparkSession, sf_dir: str, max_installments: int | None = FEED_INSTALLMENTS
) -> DataFrame:
    """``loan`` and its installment terms, one per order; by default as the feed cuts them."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan"), "o_totalprice", day("o_orderdate").alias("o_orderdate")
    )
    return lending.installment_terms(
        orders,
        F.col("o_totalprice"),
        8 + (F.col("loan") % 120) / 10,
        (F.col("loan") % 360 + 12).cast("int"),
        F.col("o_orderdate"),
        max_installments,
    ).drop("o_totalprice", "o_orderdate")


def line_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loan, value_date, paid_cents``, one per lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("loan"),
        day("l_shipdate").alias("value_date"),
        cents(F.col("l_extendedprice")).alias("paid_cents"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``dt`` and ``batch`` (1 before noon, 2 after)."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("dt", day("ts"))
        .withColumn("batch", F.expr("cast(hour(ts) div 12 + 1 as int)"))
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load events: STARTED and an outcome per order, a heartbeat per lineitem.

    About one order in twenty never ends.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("log_id"),
        F.col("o_custkey").alias("run_id"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("table_id"),
        day("o_orderdate").alias("run_dt"),
        F.col("o_orderdate").alias("opened"),
        F.element_at(
            F.create_map(*[F.lit(x) for pair in STATUS_OF_ORDER.items() for x in pair]),
            F.col("o_orderstatus"),
        ).alias("outcome"),
        F.floor("o_totalprice").cast("bigint").alias("total"),
    )
    ends = ~in_hash_sample(OPEN_RATE, "log_id", salt="open")
    nothing = F.lit(None).cast("bigint")
    start = F.struct(
        F.lit(0).alias("seq"), F.lit("STARTED").alias("status"),
        nothing.alias("rows_read"), nothing.alias("rows_written"),
        F.col("opened").alias("at"),
    )
    end = F.struct(
        F.lit(1000).alias("seq"), F.col("outcome").alias("status"),
        F.col("total").alias("rows_read"),
        (F.col("total") - F.col("total") % 7).alias("rows_written"),
        (F.col("opened") + F.expr("INTERVAL 1 SECOND") * (F.col("log_id") % 5000)).alias("at"),
    )
    both = orders.withColumn(
        "event", F.explode(F.when(ends, F.array(start, end)).otherwise(F.array(start)))
    ).select("log_id", "run_id", "table_id", "run_dt", "event.*")
    beats = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("log_id"),
        nothing.alias("run_id"),
        nothing.alias("table_id"),
        F.lit(None).cast("date").alias("run_dt"),
        F.col("l_linenumber").alias("seq"),
        F.lit("STARTED").alias("status"),
        nothing.alias("rows_read"),
        nothing.alias("rows_written"),
        F.col("l_shipdate").alias("at"),
    )
    return both.unionByName(beats)


def feed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log with one entry per lineitem: part = feed, ship month = business date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("table_id"),
        F.trunc("l_shipdate", "month").alias("run_dt"),
        F.when(F.col("l_returnflag") == "A", "SUCCESS")
        .when(F.col("l_returnflag") == "R", "FAILED")
        .otherwise("SKIPPED")
        .alias("status"),
    )


def feed_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table registry with one entry per part; every twentieth is switched off."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("table_id"),
        F.col("p_name").alias("source_table_name"),
        F.col("p_size").alias("load_priority"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
    )


def feed_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer rules for the registry: up to three layers, up to three upstream feeds."""
    key = F.col("p_partkey")
    upstream = F.concat_ws(
        ", ", (key % 97).cast("string"), (key % 89).cast("string"), (key % 83).cast("string")
    )
    layers = F.array(F.lit("BRONZE"), F.lit("SILVER"), F.lit("GOLD"))
    return (
        table(spark, sf_dir, "part")
        .select(
            key.alias("table_id"),
            F.explode(F.slice(layers, F.lit(1), (key % 3 + 1).cast("int"))).alias("process_type"),
            upstream.alias("listed"),
        )
        .select(
            "table_id",
            "process_type",
            F.when(F.col("process_type") == "BRONZE", "INCREMENTAL")
            .otherwise("FULL")
            .alias("load_type"),
            F.when(F.col("process_type") != "BRONZE", F.col("listed")).alias(
                "depends_on_table_ids"
            ),
            (F.col("table_id") % 30 != 0).alias("is_active"),
        )
    )


# ---- the same views as SQL ---------------------------------------------------


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sampled(rate: float, salt: str, *parts: str) -> str:
    """SQL of the hash sample."""
    cut = hash_cut(rate)
    text = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '<null>')" for p in parts)
    return f"substr(md5(concat_ws('|', '{salt}', {text})), 1, {len(cut)}) < '{cut}'"


def rounded(amount: str) -> str:
    """SQL of a double rounded to cents as Spark does it: half up on its decimal text."""
    return f"CAST(CAST(CAST({amount} AS VARCHAR) AS DECIMAL(20,2)) * 100 AS BIGINT)"


IDS_SQL = f"""ids AS (
  SELECT c_custkey + 1 AS id,
         CAST(DATE '{FIRST_DAY}' + CAST((c_custkey + 1) % {DAYS} AS INTEGER) AS DATE) AS dt
  FROM customer)"""

_DAY_START = "CAST(CAST(dt AS TIMESTAMP) AS VARCHAR)"
_USER = "'USER' || lpad(CAST(id % 100 + 1 AS VARCHAR), 4, '0')"

CLIENTS_SQL = f"""clients AS (
  SELECT id, dt,
    lpad(CAST(id % 50 + 1 AS VARCHAR), 4, '0') AS "OurBranchID",
    'CL' || lpad(CAST(id AS VARCHAR), 10, '0') AS "ClientID",
    {_listed(FIRST_NAMES)}[id % 14 + 1] || ' ' || {_listed(LAST_NAMES)}[(id + 7) % 14 + 1]
      AS "ClientName",
    CASE WHEN id % 10 = 0 THEN 'CORPORATE' WHEN id % 5 = 0 THEN 'SME' ELSE 'INDIVIDUAL' END
      AS "ClientType",
    CAST(DATE '{TODAY}' - CAST(id % 20805 + 6570 AS INTEGER) AS DATE) AS "DOB",
    id % 20 <> 0 AS "IsActive",
    {_listed(STATES)}[id % 10 + 1] AS "State",
    'IND' AS "Country",
    {_DAY_START} AS "CreatedAt", {_USER} AS "CreatedBy", {_DAY_START} AS "LastUpdatedAt"
  FROM ids)"""


def accounts_sql(seq_width: int = 4) -> str:
    return f"""slots AS (
  SELECT id, dt, slot, 2 * (id - 1) + slot AS seq,
    {rounded("pow(10.0, 3 + (id % 100) / 25.0)")} AS balance
  FROM ids, unnest(generate_series(1, CASE WHEN id % 2 = 0 THEN 2 ELSE 1 END)) AS s(slot)),
accounts AS (
  SELECT id, dt, slot,
    lpad(CAST(id % 50 + 1 AS VARCHAR), 4, '0') AS "OurBranchID",
    'CL' || lpad(CAST(id AS VARCHAR), 10, '0') AS "ClientID",
    lpad(CAST(id % 50 + 1 AS VARCHAR), 4, '0') || 'LN'
      || lpad(CAST(seq AS VARCHAR), CAST(greatest(length(CAST(seq AS VARCHAR)), {seq_width}) AS INTEGER), '0')
      AS "AccountID",
    CASE WHEN slot = 1 THEN ['PL001', 'PL002', 'HL001', 'HL002', 'GL001'][id % 5 + 1]
         ELSE ['GL001', 'BL001', 'PL002'][(id + 3) % 3 + 1] END AS "ProductID",
    CASE WHEN slot = 1 THEN 'LOAN_PRIMARY' ELSE 'LOAN_SECONDARY' END AS "AccountType",
    balance AS balance_cents,
    {rounded("balance / 100.0 * (id % 10) / 100")} AS freeze_cents,
    CASE WHEN id % 50 = 0 THEN 'CLOSED' WHEN id % 25 = 0 THEN 'DORMANT'
         WHEN id % 15 = 0 THEN 'FROZEN' ELSE 'ACTIVE' END AS "AccountStatus",
    {_DAY_START} AS "CreatedAt", {_USER} AS "CreatedBy", {_DAY_START} AS "LastUpdatedAt"
  FROM slots)"""


LOANS_SQL = f"""series AS (
  SELECT a.id, a.dt, a."OurBranchID", a."AccountID", CAST(n AS INTEGER) AS "LoanSeries",
    {rounded("pow(10.0, 4 + (id % 100) / 20.0)")} AS sanction,
    id % 120 + 80 AS tenths,
    CAST(id % 360 + 12 AS INTEGER) AS "Tenure",
    "CreatedAt", "CreatedBy", "LastUpdatedAt"
  FROM accounts a,
    unnest(generate_series(1, CASE WHEN a.id % 3 = 0 THEN 2 ELSE 1 END)) AS s(n)),
loans AS (
  SELECT *,
    {rounded("sanction / 100.0 * CAST(0.95 AS DOUBLE)")} AS disbursed,
    {rounded('sanction / 100.0 * (tenths / 10.0) / 100 * "Tenure" / 12')} AS interest,
    CASE WHEN id % 100 < 60 THEN 'ACTIVE' WHEN id % 100 < 80 THEN 'CLOSED'
         WHEN id % 100 < 90 THEN 'NPA' WHEN id % 100 < 95 THEN 'WRITTEN_OFF'
         ELSE 'RESTRUCTURED' END AS "LoanStatus",
    CASE id % 4 WHEN 0 THEN 'QUARTERLY' WHEN 1 THEN 'WEEKLY' ELSE 'MONTHLY' END AS "Frequency",
    CASE id % 3 WHEN 0 THEN 'BULLET' WHEN 1 THEN 'INTEREST_ONLY' ELSE 'EMI' END
      AS "RepaymentType",
    'FUND' || lpad(CAST(id % 10 + 1 AS VARCHAR), 3, '0') AS "FundID",
    upper(md5("OurBranchID" || '|' || "AccountID" || '|' || CAST("LoanSeries" AS VARCHAR)))
      AS "LoanID",
    CAST(dt + to_months("Tenure") AS DATE) AS "MaturityDate"
  FROM series)"""

INSTALLMENTS_SQL = f"""terms AS (
  SELECT *, CAST(least(36, "Tenure") AS INTEGER) AS n FROM loans),
installments AS (
  SELECT t.id, t.dt, t."OurBranchID", t."AccountID", t."LoanSeries", t."LoanID",
    CAST(k AS INTEGER) AS "InstallmentNo",
    CAST(t.dt + to_months(CAST(k AS INTEGER)) AS DATE) AS "InstallmentDate",
    {rounded("sanction / 100.0 / n")} AS principal,
    {rounded("sanction / 100.0 * (tenths / 10.0) / 100 / 12")} AS interest_due,
    "CreatedAt", "CreatedBy", "LastUpdatedAt"
  FROM terms t, unnest(generate_series(1, n)) AS s(k))"""


def ledger_sql(day_filter: str) -> str:
    """Disbursements, and repayments of the installments due as ``day_filter`` says."""
    keep = sampled(lending.REPAYMENT_RATE, "repay", '"LoanID"', '"InstallmentNo"')
    return f"""movements AS (
  SELECT "OurBranchID", "AccountID", "LoanID", "LoanSeries", 'DISBURSEMENT' AS "TrxType",
    'CR' AS "DrCr", disbursed AS amount, CAST(dt AS TIMESTAMP) + INTERVAL 10 HOUR AS moved_at,
    dt AS "ValueDate", CAST(0 AS BIGINT) AS principal, CAST(0 AS BIGINT) AS interest_part
  FROM loans
  UNION ALL
  SELECT "OurBranchID", "AccountID", "LoanID", "LoanSeries", 'REPAYMENT', 'DR',
    principal + interest_due, CAST("InstallmentDate" AS TIMESTAMP) + INTERVAL 14 HOUR,
    "InstallmentDate", principal, interest_due
  FROM installments WHERE {day_filter} AND {keep}),
ledger AS (
  SELECT *, 'TRX' || substr(upper(md5("AccountID" || '|' || "LoanID" || '|'
      || CAST("LoanSeries" AS VARCHAR) || '|' || "TrxType" || '|' || CAST(moved_at AS VARCHAR))), 1, 14)
      AS "TrxID"
  FROM movements)"""


def order_terms_sql(count: str) -> str:
    """The schedule of a loan per order, with as many installments as ``count`` says."""
    return f"""terms AS (
  SELECT o_orderkey AS loan, CAST(o_orderdate AS DATE) AS d0,
    CAST({count} AS INTEGER) AS n,
    CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
    o_totalprice AS amount, 8 + (o_orderkey % 120) / 10.0 AS rate
  FROM orders),
priced AS (
  SELECT *, {rounded("amount / n")} AS p,
    {rounded("amount * rate / 100 / 12")} AS i FROM terms),
schedule AS (
  SELECT t.*, CAST(k AS INTEGER) AS k, CAST(d0 + to_months(CAST(k AS INTEGER)) AS DATE) AS due_date
  FROM priced t, unnest(generate_series(1, n)) AS s(k))"""

_TENURE_SQL = "o_orderkey % 360 + 12"
ORDER_TERMS_SQL = order_terms_sql(f"least({FEED_INSTALLMENTS}, {_TENURE_SQL})")
FULL_TERMS_SQL = order_terms_sql(_TENURE_SQL)

PAYMENTS_SQL = """payments AS (
  SELECT l_orderkey AS loan, CAST(l_shipdate AS DATE) AS value_date,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS paid_cents
  FROM lineitem)"""

FEED_SQL = """feed AS (
  SELECT *, CAST(ts AS DATE) AS dt, CAST(hour(ts) // 12 + 1 AS INTEGER) AS batch FROM events)"""

_OPEN = sampled(OPEN_RATE, "open", "o_orderkey")

RUN_LOG_SQL = f"""beats AS (
  SELECT l_orderkey, max(l_shipdate) AS last_beat, max(l_linenumber) AS last_line
  FROM lineitem GROUP BY l_orderkey),
log AS (
  SELECT o_orderkey AS log_id, o_custkey AS run_id,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS table_id,
    CAST(o_orderdate AS DATE) AS run_dt,
    CASE WHEN {_OPEN} THEN 'STARTED' WHEN o_orderstatus = 'F' THEN 'SUCCESS'
         WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'SKIPPED' END AS status,
    CASE WHEN NOT {_OPEN} THEN CAST(floor(o_totalprice) AS BIGINT) END AS rows_read,
    CASE WHEN NOT {_OPEN} THEN CAST(floor(o_totalprice) AS BIGINT)
      - CAST(floor(o_totalprice) AS BIGINT) % 7 END AS rows_written,
    CAST(o_orderdate AS TIMESTAMP) AS started_at,
    CASE WHEN NOT {_OPEN} THEN CAST(o_orderdate AS TIMESTAMP)
      + to_seconds(o_orderkey % 5000) END AS finished_at,
    greatest(CAST(o_orderdate AS TIMESTAMP), last_beat,
      CASE WHEN NOT {_OPEN} THEN CAST(o_orderdate AS TIMESTAMP)
        + to_seconds(o_orderkey % 5000) END) AS heartbeat_at,
    CASE WHEN NOT {_OPEN} THEN o_orderkey % 5000 END AS duration_seconds
  FROM orders LEFT JOIN beats ON o_orderkey = l_orderkey)"""

FEED_LOG_SQL = """feed_log AS (
  SELECT l_partkey AS table_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS run_dt,
    CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'R' THEN 'FAILED' ELSE 'SKIPPED' END AS status
  FROM lineitem)"""

REGISTRY_SQL = """registry AS (
  SELECT p_partkey AS table_id, p_name AS source_table_name, p_size AS load_priority,
    p_partkey % 20 <> 0 AS is_active FROM part),
layers AS (
  SELECT p_partkey AS table_id, process_type,
    CASE WHEN process_type = 'BRONZE' THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type,
    CASE WHEN process_type <> 'BRONZE' THEN concat_ws(', ', CAST(p_partkey % 97 AS VARCHAR),
      CAST(p_partkey % 89 AS VARCHAR), CAST(p_partkey % 83 AS VARCHAR)) END
      AS depends_on_table_ids,
    p_partkey % 30 <> 0 AS is_active
  FROM part, unnest(['BRONZE', 'SILVER', 'GOLD'][1:p_partkey % 3 + 1]) AS s(process_type))"""


def with_sql(*views: str) -> str:
    """``WITH`` over the given views, ready for a SELECT."""
    return "WITH " + ",\n".join(views) + "\n"


def loans_sql(seq_width: int = 4) -> list[str]:
    return [IDS_SQL, accounts_sql(seq_width), LOANS_SQL]
